"""Windows over a whole book see places and ids, and no content: a book's content need not fit in one task."""

import pytest
from pyspark.sql import functions as F

from folio.plans import books

def contents_of_book_windows(df):
    found, todo = set(), [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "Window" and node.partitionSpec().size() == 1 and "at#" not in node.partitionSpec().toString():
            out = node.output()
            found |= {out.apply(i).name() for i in range(out.size()) if "source_typography" in out.apply(i).dataType().catalogString()}
    return found


@pytest.mark.parametrize("name", ["q46_analyzed_nodes", "q48_neighbour_links", "q49_continuation_links", "q51_resolved_nodes"])
def test_windows_of_books_see_no_content(spark, name):
    assert contents_of_book_windows(getattr(books, name)(spark, "/root/testdata/sf0.001")) == set()


def test_pages_of_one_place_are_numbered_once_each(spark):
    pages = spark.range(6).select(F.lit("a").alias("book_id"), F.floor(F.col("id") / 2).alias("page_pos"), F.lit(1).alias("page_number"), F.lit(None).cast(books.E.PAGE_TYPE).alias("page"))
    assert sorted(r.page_index for r in books.A.ordered_pages(pages).collect()) == list(range(6))
