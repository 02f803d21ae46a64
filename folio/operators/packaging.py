"""EPUB packages: navigation, package document, validation of links and layout, and the archive itself.

Navigation and links are tables of entries and hrefs, checked by joins for all books at once. Only the archive of one
book is put together in one task, from the rows of its files.
"""

from __future__ import annotations

import datetime
import hashlib
import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import escape_markup
from folio.operators.rendering import ENDNOTES

# Fixed values of the format.
MIMETYPE = "application/epub+zip"
REQUIRED = ("META-INF/container.xml", "EPUB/package.opf", "EPUB/nav.xhtml")
NAVIGATION_LEVELS = {"chapter_title": 1, "section_title": 2, "subsection_title": 3}
MEDIA_TYPES = {"gif": "image/gif", "jpeg": "image/jpeg", "jpg": "image/jpeg", "png": "image/png", "svg": "image/svg+xml", "css": "text/css", "xhtml": "application/xhtml+xml"}
CONTAINER = '<?xml version="1.0" encoding="utf-8"?>\n<container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container">\n  <rootfiles>\n    <rootfile full-path="EPUB/package.opf" media-type="application/oebps-package+xml" />\n  </rootfiles>\n</container>\n'
STYLES = "body { line-height: 1.5; }\n.source-italic { font-style: italic; }\n.verse-line { margin: 0; }\n.attribution { text-align: right; }\n.heading-label { font-weight: bold; }\n"
METADATA_FIELDS = ("title", "subtitle", "language", "authors", "publisher", "publication_date", "isbn", "description", "subjects", "rights", "series", "series_index", "contributors", "cover")
METADATA_TYPE = ", ".join(f"{f} {'array<string>' if f in ('authors', 'subjects', 'contributors') else 'string'}" for f in METADATA_FIELDS)
#: Namespace text of derived identifiers.
IDENTIFIER_PREFIX = "folio:"


def navigation_text(content: Column) -> Column:
    """A heading's text without its references to notes; where one stood between words, they stay apart."""

    def step(state: Column, i: Column) -> Column:
        text, done = i["text"], state["text"]
        bare = (done == "") | (text == "") | done.rlike(r"(?U)(\s|[(\[{«“‘/-])\z") | text.rlike(r"(?U)^(\s|[,.;:!?)\]}»”’])")
        gap = F.when(state["left"] & ~bare, " ").otherwise("")
        ref = i["target_id"].isNotNull()
        return F.struct(F.when(ref, done).otherwise(F.concat(done, gap, text)).alias("text"), F.when(ref, state["left"] | text.rlike(r"(?U)\S")).otherwise(F.lit(False)).alias("left"))

    return F.aggregate(content, F.struct(F.lit("").alias("text"), F.lit(False).alias("left")), step, lambda s: F.regexp_replace(s["text"], r"(?U)^\s+|\s+\z", ""))


def navigation_level(role: Column, level: Column) -> Column:
    """1 to 3 by role; a scenario title's own level, 3 if it has none; null for headings that are no aim of navigation."""
    out = F.when(role == "scenario_title", F.when(level.between(1, 6), level).otherwise(3))
    for name, n in NAVIGATION_LEVELS.items():
        out = out.when(role == name, n)
    return out


def toc_entries(chunks: DataFrame) -> DataFrame:
    """(book_id, node_pos, label, target_id, file, level, depth, parent) of headings that navigation aims at. An entry is at
    most one deeper than the one before; parent is the nearest earlier entry one level up."""
    rows = chunks.where("node_type = 'heading'").select("book_id", "node_pos", navigation_text(F.col("content")).alias("label"), F.col("node_id").alias("target_id"), "file", navigation_level(F.col("role"), F.col("level")).alias("level")).where("level is not null and label <> ''")
    w = Window.partitionBy("book_id").orderBy("node_pos")
    rows = rows.withColumn("_n", F.row_number().over(w))
    lowest = F.min(F.greatest("level", F.lit(1)) - F.col("_n")).over(w)
    rows = rows.withColumn("depth", (F.col("_n") + F.least(F.lit(0), lowest)).cast("int"))
    up = None
    for d in range(1, 6):
        last = F.last(F.when(F.col("depth") == d, F.col("target_id")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        up = F.when(F.col("depth") == d + 1, last) if up is None else up.when(F.col("depth") == d + 1, last)
    return rows.withColumn("parent", up).drop("_n")


def toc_markup(entries: DataFrame) -> DataFrame:
    """(book_id, items): nested list items. An entry opens a list if the next is deeper, and closes as many as the next is less deep."""
    w = Window.partitionBy("book_id").orderBy("node_pos")
    nxt = F.coalesce(F.lead("depth").over(w), F.lit(1))
    pad = lambda d: F.repeat(F.lit(" "), (F.lit(4) + 4 * d).cast("int"))
    link = F.concat(pad(F.col("depth")), F.lit('<li><a href="'), escape_markup(F.concat("file", F.lit("#"), "target_id")), F.lit('">'), escape_markup(F.col("label")), F.lit("</a>"))
    opened = F.concat(link, F.lit("\n"), pad(F.col("depth")), F.lit("  <ol>\n"))
    ends = F.array_join(F.transform(F.when(F.col("depth") > nxt, F.sequence(F.col("depth") - 1, nxt, F.lit(-1))).otherwise(F.array().cast("array<int>")), lambda d: F.concat(pad(d), F.lit("  </ol>\n"), pad(d), F.lit("</li>\n"))), "")
    rows = entries.select("book_id", "node_pos", F.when(nxt > F.col("depth"), opened).otherwise(F.concat(link, F.lit("</li>\n"), ends)).alias("m"))
    return rows.groupBy("book_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node_pos", "m"))), lambda x: x["m"]), "").alias("items"))


def navigation_documents(books: DataFrame, documents: DataFrame, entries: DataFrame) -> DataFrame:
    """(book_id, content): nav.xhtml of each book: its entries, or the book itself if there are none, and landmarks.
    documents (book_id, position, file), of which one named cover.xhtml is the cover."""
    named = lambda name: F.substring_index("file", "/", -1) == name
    body = ~named("cover.xhtml") & ~named(ENDNOTES)
    of = documents.groupBy("book_id").agg(F.coalesce(F.min_by("file", F.when(body, F.col("position"))), F.min_by("file", "position")).alias("first"), F.min(F.when(named("cover.xhtml"), F.col("file"))).alias("_cover"), F.min(F.when(named(ENDNOTES), F.col("file"))).alias("_notes"))
    rows = books.join(of, "book_id").join(toc_markup(entries), "book_id", "left")
    tongue, title = escape_markup(F.coalesce("language", F.lit("und"))), escape_markup(F.col("title"))
    mark = lambda kind, href, name: F.concat(F.lit(f'        <li><a epub:type="{kind}" href="'), href, F.lit(f'">{name}</a></li>\n'))
    marks = F.concat(F.coalesce(mark("cover", F.col("_cover"), "Cover"), F.lit("")), mark("bodymatter", F.col("first"), "Start of Content"), F.coalesce(mark("endnotes", F.concat("_notes", F.lit("#endnotes")), "Notes"), F.lit("")))
    alone = F.concat(F.lit('        <li><a href="'), "first", F.lit('">'), title, F.lit("</a></li>\n"))
    text = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops" lang="'), tongue, F.lit('" xml:lang="'), tongue,
        F.lit('">\n  <head>\n    <meta charset="utf-8" />\n    <title>'), title, F.lit('</title>\n  </head>\n  <body>\n    <nav epub:type="toc" id="toc">\n      <h1>'), title, F.lit("</h1>\n      <ol>\n"),
        F.coalesce("items", alone), F.lit('      </ol>\n    </nav>\n    <nav epub:type="landmarks" id="landmarks">\n      <h2>Landmarks</h2>\n      <ol>\n'), marks, F.lit("      </ol>\n    </nav>\n  </body>\n</html>\n"),
    )
    return rows.select("book_id", text.alias("content"))


def isbn_identifier(isbn: Column) -> Column:
    bare = F.trim(isbn)
    return F.when(F.lower(bare).startswith("urn:isbn:"), bare).otherwise(F.concat(F.lit("urn:isbn:"), bare))


def checked_timestamp(value: str | None) -> str:
    """A UTC time to the second; now if there is none. ValueError for anything else."""
    if value is None:
        return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    if datetime.datetime.strptime(value, "%Y-%m-%dT%H:%M:%SZ").strftime("%Y-%m-%dT%H:%M:%SZ") != value:
        raise ValueError(f"not YYYY-MM-DDTHH:MM:SSZ: {value}")
    return value


def _tag(name: str, value: Column, attributes: str = "") -> Column:
    """An element of the metadata; empty if the value is null."""
    return F.coalesce(F.concat(F.lit(f"    <{name}{attributes}>"), escape_markup(value), F.lit(f"</{name}>\n")), F.lit(""))


def _tags(name: str, values: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(values, lambda v: _tag(name, v)), ""), F.lit(""))


def package_documents(books: DataFrame, files: DataFrame, modified: str) -> DataFrame:
    """(book_id, content): package.opf of books (book_id, identifier, METADATA_FIELDS). files (book_id, position, file) are relative
    to it: documents, in the order of the spine, a stylesheet, assets."""
    ending = F.lower(F.regexp_extract("file", r"\.([^./]+)\z", 1))
    kind = None
    for e, t in MEDIA_TYPES.items():
        kind = F.when(ending == e, t) if kind is None else kind.when(ending == e, t)
    group = F.when(ending == "xhtml", "content").when(ending == "css", "css").otherwise("asset")
    rows = files.withColumn("group", group).withColumn("kind", kind).withColumn("cover", F.col("file").rlike(r"^(text/cover\.xhtml|assets/cover\.(gif|jpe?g|png|svg))\z"))
    unknown = rows.where("kind is null").limit(5).collect()
    if unknown:
        raise ValueError(f"no media type: {[r['file'] for r in unknown]}")
    w = Window.partitionBy("book_id", "group", "cover").orderBy(F.when(F.col("group") == "content", F.col("position")).otherwise(0), "file")
    count = F.count("*").over(Window.partitionBy("book_id", "group", "cover"))
    number = F.format_string("%04d", F.row_number().over(w))
    item = F.when(F.col("group") == "css", "css").when(F.col("cover"), F.when(F.col("group") == "content", "cover").otherwise("cover-image")).when((F.col("group") == "content") & (count == 1), "content").otherwise(F.concat("group", F.lit("-"), number))
    rows = rows.withColumn("id", item)
    rank = F.when(F.col("group") == "content", 0).when(F.col("group") == "css", 1).otherwise(2)
    line = F.concat(F.lit('    <item id="'), "id", F.lit('" href="'), escape_markup(F.col("file")), F.lit('" media-type="'), "kind", F.when(F.col("id") == "cover-image", '" properties="cover-image" />\n').otherwise('" />\n'))
    spine = F.when(F.col("group") == "content", F.struct("position", F.concat(F.lit('    <itemref idref="'), "id", F.lit('" />\n')).alias("m")))
    both = rows.groupBy("book_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(rank.alias("r"), F.when(F.col("group") == "content", F.col("position")).otherwise(0).alias("p"), "file", line.alias("m")))), lambda x: x["m"]), "").alias("manifest"), F.array_join(F.transform(F.sort_array(F.collect_list(spine)), lambda x: x["m"]), "").alias("spine"))
    b = books.join(both, "book_id")
    c = F.col
    creators = F.array_join(F.transform("authors", lambda a, i: F.concat(F.lit('    <dc:creator id="creator-'), (i + 1).cast("string"), F.lit('">'), escape_markup(a), F.lit("</dc:creator>\n"))), "")
    meta = F.concat(
        _tag("dc:identifier", c("identifier"), ' id="pub-id"'), _tag("dc:title", c("title"), ' id="main-title"'), F.lit('    <meta refines="#main-title" property="title-type">main</meta>\n'), _tag("dc:language", F.coalesce("language", F.lit("und"))),
        F.when(c("subtitle").isNotNull(), F.concat(_tag("dc:title", c("subtitle"), ' id="subtitle"'), F.lit('    <meta refines="#subtitle" property="title-type">subtitle</meta>\n'))).otherwise(""),
        F.coalesce(creators, F.lit("")), _tags("dc:contributor", c("contributors")), _tag("dc:publisher", c("publisher")), _tag("dc:date", c("publication_date")), _tag("dc:identifier", isbn_identifier(c("isbn"))),
        _tag("dc:description", c("description")), _tags("dc:subject", c("subjects")), _tag("dc:rights", c("rights")),
        F.when(c("series").isNotNull(), F.concat(_tag("meta", c("series"), ' property="belongs-to-collection" id="series"'), F.lit('    <meta refines="#series" property="collection-type">series</meta>\n'), _tag("meta", c("series_index"), ' refines="#series" property="group-position"'))).otherwise(""),
        F.lit(f'    <meta property="dcterms:modified">{modified}</meta>\n'),
    )
    text = F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?>\n<package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="pub-id">\n  <metadata xmlns:dc="http://purl.org/dc/elements/1.1/">\n'), meta, F.lit('  </metadata>\n  <manifest>\n    <item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav" />\n'), "manifest", F.lit("  </manifest>\n  <spine>\n"), "spine", F.lit("  </spine>\n</package>\n"))
    return b.select("book_id", text.alias("content"))


def identified(books: DataFrame, files: DataFrame) -> DataFrame:
    """books with identifier: as given, else a name-based UUID of the metadata and of all files (book_id, file, data binary)."""
    stamp = files.groupBy("book_id").agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("file", F.sha2("data", 256).alias("h")))), lambda x: F.concat(x["file"], F.lit("\0"), x["h"])), "\n"), 256).alias("_files"))
    meta = F.to_json(F.struct(*METADATA_FIELDS))

    @F.pandas_udf("string")
    def urn(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, IDENTIFIER_PREFIX + hashlib.sha256(t.encode()).hexdigest())}")

    rows = books.join(stamp, "book_id", "left")
    given = F.col("identifier") if "identifier" in books.columns else F.lit(None).cast("string")
    return rows.withColumn("identifier", F.coalesce(given, urn(F.concat(meta, F.lit("\0"), F.coalesce("_files", F.lit("")))))).drop("_files")


def archives(files: DataFrame) -> DataFrame:
    """(book_id, epub binary) of all files (book_id, position, member, data): the type first and stored, then the members in order,
    with fixed times, so that equal books give equal bytes. A book's files are put together in one task."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data, how in [("mimetype", MIMETYPE.encode(), zipfile.ZIP_STORED), *((m, d, zipfile.ZIP_DEFLATED) for m, d in frame.sort_values(["position", "member"])[["member", "data"]].itertuples(index=False))]:
                info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
                info.compress_type, info.create_system, info.external_attr = how, 0, 0o600 << 16
                z.writestr(info, bytes(data))
        return pd.DataFrame({"book_id": [frame["book_id"].iloc[0]], "epub": [out.getvalue()]})

    return files.select(F.col("book_id").cast("string").alias("book_id"), "position", "member", F.col("data").cast("binary").alias("data")).groupBy("book_id").applyInPandas(build, "book_id string, epub binary")


def packaged(books: DataFrame, documents: DataFrame, entries: DataFrame, assets: DataFrame, modified: str | None = None) -> DataFrame:
    """(book_id, epub) of books (book_id, METADATA_FIELDS), documents (book_id, position, file, content), entries of toc_entries() and
    assets (book_id, file, data). Raises ValueError for a book without title or with two files of one name. Each is read several
    times, so give it tables that were written, not the plans of a whole analysis."""
    if not books.where("title is null or trim(title) = ''").isEmpty():
        raise ValueError("a book needs a title")
    text = documents.select("book_id", "position", F.concat(F.lit("text/"), "file").alias("file"), F.col("content").cast("binary").alias("data"))
    styles = books.select("book_id", F.lit(0).alias("position"), F.lit("styles/book.css").alias("file"), F.lit(STYLES).cast("binary").alias("data"))
    files = text.unionByName(styles).unionByName(assets.select("book_id", F.lit(0).alias("position"), "file", "data"))
    if not files.groupBy("book_id", "file").count().where("count > 1").isEmpty():
        raise ValueError("two files of one name")
    named = identified(books, files)
    placed = documents.select("book_id", "position", F.concat(F.lit("text/"), "file").alias("file"))
    nav = navigation_documents(books, placed, entries.withColumn("file", F.concat(F.lit("text/"), "file")))
    opf = package_documents(named, files.select("book_id", "position", "file"), checked_timestamp(modified))
    member = lambda df, name, at: df.select("book_id", F.lit(at).alias("position"), F.lit(name).alias("member"), F.col("content").cast("binary").alias("data"))
    rest = files.select("book_id", (F.col("position") + 4).cast("int").alias("position"), F.concat(F.lit("EPUB/"), "file").alias("member"), "data")
    container = books.select("book_id", F.lit(1).alias("position"), F.lit("META-INF/container.xml").alias("member"), F.lit(CONTAINER).cast("binary").alias("data"))
    return archives(container.unionByName(member(opf, "EPUB/package.opf", 2)).unionByName(member(nav, "EPUB/nav.xhtml", 3)).unionByName(rest))


def plain_path(path: Column) -> Column:
    """A path without . and empty parts, and without folders that it leaves again; what leaves the root begins with .. still, and an absolute path
    with /."""
    none = F.array().cast("array<string>")
    stack = F.aggregate(
        F.split(path, "/"),
        none,
        lambda done, part: F.when(part.isin("", "."), done)
        .when((part == "..") & (F.size(done) > 0) & (F.coalesce(F.element_at(done, -1), F.lit("..")) != ".."), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.when(path.startswith("/"), "/").otherwise(""), F.array_join(stack, "/"))


def link_problems(links: DataFrame, ids: DataFrame, documents: DataFrame) -> DataFrame:
    """links (book_id, source, href, navigation) that lead nowhere, with problem. ids (book_id, file, id), documents (book_id, file).

    Links to other sites are fine but in navigation. A path is relative to its source; leaving the package, a document
    that isn't in the spine (of navigation, or with a fragment) and a fragment that isn't there are problems.
    """
    external = F.lower("href").rlike("^(https?|mailto|tel):")
    path, fragment = F.substring_index("href", "#", 1), F.when(F.col("href").contains("#"), F.regexp_extract("href", "#(.*)", 1))
    folder = F.regexp_extract("source", r"^(.*/)?[^/]*\z", 1)
    full = plain_path(F.concat(folder, path))
    rows = links.where(F.col("navigation") | ~external).withColumn("file", F.when(path == "", F.col("source")).otherwise(full)).withColumn("id", fragment)
    there = documents.select("book_id", "file", F.lit(True).alias("_doc")).distinct()
    known = ids.select("book_id", "file", "id", F.lit(True).alias("_id")).distinct()
    rows = rows.join(there, ["book_id", "file"], "left").join(known, ["book_id", "file", "id"], "left")
    problem = F.when(F.col("file").startswith("/") | F.col("file").rlike(r"(^|/)\.\.(/|\z)"), "leaves the package").when(F.col("_doc").isNull() & (F.col("navigation") | F.col("id").isNotNull()), "no such document").when(F.col("id").isNotNull() & F.col("_id").isNull(), "no such id")
    return rows.withColumn("problem", problem).where("problem is not null").select("book_id", "source", "href", "problem")


def markup_ids(documents: DataFrame) -> DataFrame:
    """(book_id, file, id) of XHTML documents (book_id, file, content)."""
    return documents.select("book_id", "file", F.explode(F.expr("xpath(content, '//@id')")).alias("id"))


def markup_links(documents: DataFrame, navigation: bool = False) -> DataFrame:
    """(book_id, source, href, navigation) of the anchors of documents."""
    return documents.select("book_id", F.col("file").alias("source"), F.explode(F.expr("xpath(content, '//*[local-name()=\"a\"]/@href')")).alias("href"), F.lit(navigation).alias("navigation"))


def archive_problems(epub: bytes) -> list[str]:
    """What is wrong with an archive: type, members, paths, package, spine. Links are link_problems()'."""
    try:
        z = zipfile.ZipFile(io.BytesIO(epub))
        infos = z.infolist()
        names = {i.filename for i in infos}
        found = [f"missing {n}" for n in REQUIRED if n not in names]
        found += [f"unsafe path {n}" for n in sorted(names) if n.startswith("/") or ".." in n.split("/")]
        if not infos or infos[0].filename != "mimetype" or infos[0].compress_type != zipfile.ZIP_STORED or z.read("mimetype") != MIMETYPE.encode():
            found.append("mimetype is not first, stored and right")
        if found:
            return found
        root = next((e for e in ElementTree.fromstring(z.read("META-INF/container.xml")).iter() if e.tag.endswith("}rootfile")), None)
        if root is None or root.get("full-path") != "EPUB/package.opf":
            found.append("the container doesn't name the package")
        package = ElementTree.fromstring(z.read("EPUB/package.opf"))
        items = {e.get("id"): e.get("href") for e in package.iter() if e.tag.endswith("}item")}
        found += [f"manifest names missing {h}" for h in items.values() if f"EPUB/{h}" not in names]
        spine = [e.get("idref") for e in package.iter() if e.tag.endswith("}itemref")]
        found += ["empty spine"] if not spine else [f"spine names unknown {s}" for s in spine if s not in items]
        return found
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError) as e:
        return [f"unreadable: {e}"]


def validated(epubs: DataFrame) -> DataFrame:
    """(book_id, problems) of (book_id, epub): layout, and links of navigation and text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for book, data in zip(f["book_id"], f["epub"], strict=True):
                bad = archive_problems(bytes(data))
                out.append((book, "", "", "", json.dumps(bad)))
                if not bad:
                    z = zipfile.ZipFile(io.BytesIO(bytes(data)))
                    for n in z.namelist():
                        if n.endswith(".xhtml"):
                            out.append((book, n.removeprefix("EPUB/"), z.read(n).decode(), "nav" if n == "EPUB/nav.xhtml" else "text", ""))
            yield pd.DataFrame(out, columns=["book_id", "file", "content", "kind", "problems"])

    parts = epubs.select(F.col("book_id").cast("string").alias("book_id"), "epub").mapInPandas(run, "book_id string, file string, content string, kind string, problems string")
    text, nav = parts.where("kind = 'text'"), parts.where("kind = 'nav'")
    broken = link_problems(markup_links(text).unionByName(markup_links(nav, True)), markup_ids(text), text.select("book_id", "file")).groupBy("book_id").agg(F.sort_array(F.collect_list(F.concat("source", F.lit(": "), "href", F.lit(": "), "problem"))).alias("links"))
    layout = parts.where("kind = ''").select("book_id", F.from_json("problems", "array<string>").alias("layout"))
    return layout.join(broken, "book_id", "left").select("book_id", F.concat("layout", F.coalesce("links", F.array().cast("array<string>"))).alias("problems"))


def snapshot(files: DataFrame) -> DataFrame:
    """(book_id, file, sha256) of files (book_id, file, data): the baseline of a proof."""
    return files.select("book_id", "file", F.sha2("data", 256).alias("sha256"))


def proof_changes(baseline: DataFrame, now: DataFrame) -> DataFrame:
    """(book_id, file, change) of snapshots: modified, added or removed; files that are the same are left out."""
    old, new = baseline.withColumnRenamed("sha256", "_old"), now.withColumnRenamed("sha256", "_new")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "modified")
    return old.join(new, ["book_id", "file"], "full_outer").select("book_id", "file", change.alias("change")).where("change is not null")
