"""How far a stream of pages is: pages done, pages a second, and the time that the rest will take."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRIC = "page_progress"


@dataclass(frozen=True)
class Progress:
    """finished: the last batch has ended. per_second and remaining_s are null until a page is done; remaining_s also where the number of pages isn't known."""

    batch: int
    pages: int
    books: int
    total: int | None
    elapsed_s: float
    per_second: float | None
    remaining_s: float | None


def observed(pages: DataFrame) -> DataFrame:
    """pages, counted as they pass: no second pass over them."""
    return pages.observe(METRIC, F.count(F.lit(1)).alias("pages"), F.approx_count_distinct("book_id").alias("books"))


class PageProgress(StreamingQueryListener):
    """Keeps the progress of the streams of a session that are observed, and tells each step to a callback. total: pages that are expected."""

    def __init__(self, total: int | None = None, tell: Callable[[Progress], None] = lambda p: None, clock: Callable[[], float] = time.monotonic) -> None:
        self.total, self.tell, self.clock = total, tell, clock
        self.steps: list[Progress] = []
        self.began, self.pages = None, 0
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self.began = self.clock() if self.began is None else self.began

    def onQueryProgress(self, event) -> None:
        row = (event.progress.observedMetrics or {}).get(METRIC)
        if row is not None:
            self.step(event.progress.batchId, row["pages"], row["books"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def step(self, batch: int, pages: int, books: int) -> Progress:
        self.pages += pages
        took = self.clock() - (self.began if self.began is not None else self.clock())
        rate = self.pages / took if self.pages and took > 0 else None
        left = max(0, self.total - self.pages) / rate if rate and self.total is not None else None
        p = Progress(batch, self.pages, books, self.total, took, rate, left)
        self.steps.append(p)
        self.tell(p)
        return p
