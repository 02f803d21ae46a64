"""Figures cut out of the images of their pages by plug-ins for size and crop, each page's image dealt once for all its figures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.rendering import figure_sources, pixel_box

#: Gives width and height of an image.
Sizer = Callable[[bytes], tuple[int, int]]
#: Gives the part (left, top, right, bottom) of an image as PNG.
Cropper = Callable[[bytes, tuple[int, int, int, int]], bytes]
BOX_TYPE = "struct<left:int,top:int,right:int,bottom:int>"
_FIGURE = "struct<node_id:string,file:string,region:struct<x:double,y:double,width:double,height:double>>"


def cropped(nodes: DataFrame, images: DataFrame, sizer: Sizer, cropper: Cropper) -> DataFrame:
    """(book_id, page_id, node_id, file, box, width, height, data) of the figures among nodes, from images (book_id, page_id, uri, image); file is the
    name that rendering gives them. Plug-ins must be importable on the executors, and what they raise fails the job.

    Raises ValueError for figures that come from no or several pages, that have no region, or whose page has no image or two. A page's image is read
    once, whatever number of figures it has; pages without figures are not read.
    """
    sources = figure_sources(nodes, images.select("book_id", "page_id", "uri"))
    bad = sources.groupBy("book_id", "node_id").agg(F.count("uri").alias("n"), F.count("region").alias("r"), F.count("*").alias("rows")).where("n <> 1 or r <> rows").limit(5).collect()
    if bad:
        raise ValueError(f"figures without one page image and a region: {[(r['book_id'], r['node_id']) for r in bad]}")
    wanted = sources.groupBy("book_id", "page_id").agg(F.sort_array(F.collect_list(F.struct("node_id", "file", "region").cast(_FIGURE))).alias("figures"))
    rows = wanted.join(images.select("book_id", "page_id", "image"), ["book_id", "page_id"]).select("book_id", "page_id", "image", "figures")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [sizer(x.as_py()) for x in batch.column("image")]
            columns = [pa.array([s[i] for s in sizes], pa.int32()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "_width", "_height"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    sized = rows.mapInArrow(measured, f"{kinds}, _width int, _height int")
    boxes = F.transform("figures", lambda f: F.struct(f["node_id"].alias("node_id"), f["file"].alias("file"), pixel_box(f["region"], F.col("_width"), F.col("_height")).cast(BOX_TYPE).alias("box")))
    placed = sized.select("book_id", "page_id", "image", boxes.alias("figures"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                book, page, image, figures = (batch.column(k)[i].as_py() for k in range(4))
                data = [cropper(image, tuple(f["box"][k] for k in ("left", "top", "right", "bottom"))) for f in figures]
                n = len(figures)
                boxes = pa.array([f["box"] for f in figures], pa.struct([(k, pa.int32()) for k in ("left", "top", "right", "bottom")]))
                yield pa.RecordBatch.from_arrays([pa.array([book] * n, pa.string()), pa.array([page] * n, pa.string()), pa.array([f["node_id"] for f in figures]), pa.array([f["file"] for f in figures]), boxes, pa.array(data, pa.binary())], ["book_id", "page_id", "node_id", "file", "box", "data"])

    made = placed.mapInArrow(cut, f"book_id string, page_id string, node_id string, file string, box {BOX_TYPE}, data binary")
    return made.select("book_id", "page_id", "node_id", "file", "box", (F.col("box.right") - F.col("box.left")).alias("width"), (F.col("box.bottom") - F.col("box.top")).alias("height"), "data")


def assets(figures: DataFrame) -> DataFrame:
    """(book_id, file, data) of cropped() figures, as packages name them."""
    return figures.select("book_id", F.concat(F.lit("assets/"), "file").alias("file"), "data")
