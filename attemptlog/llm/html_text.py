"""The main text of web pages, by the template that the pages of a host share.

A token is an element's path (names, classes, ids, digits alike) or a whole block of text at its
path. How often a token occurs on each page of a host is its occurrence vector; tokens with the
same vector form a class. A class is valid if its tokens come in the same order on every page
and, where they stand in tokens of other classes, in those of a single one. The valid classes that
half of a host's pages bear, nested in each other, are its template. What the template leaves
open are slots; the article is what fills the slots of the template's article element, or,
without one, of the innermost single element that holds most of the free text.

Side parts (menus, headers, footers, sidebars, notices, adverts, forms, comments) are known by
element, role, and words of class and id. A page that does not bear its host's template, or whose
host has none, is read by the same rules alone.

Defined results: null and empty html, and pages of side parts only, give an empty text. White space is
what Unicode calls so; ``<br>`` is white space. Blocks are parted by all elements that are not
inline. The text of an article is kept even where other pages of the host have it too. Pages
without a host form one group. Repeated rows are each extracted. An unfinished tag at the end of a
page is dropped, and so is what follows an open comment, script or style. A very long page is one row.
An empty table gives no rows; columns besides the named ones are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attemptlog.llm.common import bounded, map_rows
from attemptlog.llm.markup import ARTICLE, MAIN, Page, Reader
from attemptlog.operators.skew import join_unique
from attemptlog.session import materialize

#: A container without an article's name has to hold this share of the free text of its host.
MOST_PERCENT = 60
#: Bytes of templates that may be sent to every task; beyond it they are joined by host.
SENT_BYTES = 8 << 20
_READER: list[Reader] = []
_OUTLINE = (
    "host string, page bigint, token bigint, parent bigint, n int, first int, last int, depth int, kind int, chars bigint"
)
#: Kinds of tokens.
SIDE, PLAIN, IN_ARTICLE, IN_MAIN, TEXT = range(5)


def _read(html: str | None) -> Page:
    if not _READER:
        _READER.append(Reader())
    return _READER[0](html or "")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _outline(host: str, page: int, html: str | None):
    read = _read(html)
    for token, p in read.paths.items():
        kind = SIDE if p.aside else {ARTICLE: IN_ARTICLE, MAIN: IN_MAIN}.get(p.article, PLAIN)
        yield host, page, token, p.parent, p.count, p.first, p.last, p.depth, kind, p.chars
    texts: dict[int, list[int]] = {}
    for block in read.blocks:
        texts.setdefault(block.token, [block.within]).append(block.order)
    for token, (within, *orders) in texts.items():
        yield host, page, token, within, len(orders), orders[0], orders[-1], 0, TEXT, 0


def outlines(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Per page and token: occurrences, first and last place, and the token it stands in."""
    text = F.col(f"`{html}`")
    named = pages.select(
        host_of(F.col(f"`{url}`")).alias("host"), F.xxhash64(F.col(f"`{url}`"), text).alias("page"), text.alias("html")
    )
    names = [c.split()[0] for c in _OUTLINE.split(", ")]

    def run(batches):
        for batch in batches:
            for piece in bounded(batch, 1 << 20):
                rows = [r for page in zip(*(c.to_pylist() for c in piece.columns)) for r in _outline(*page)]
                if rows:
                    types = [pa.string(), *[pa.int64()] * 3, *[pa.int32()] * 5, pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return named.mapInArrow(run, _OUTLINE)


def _sums(hashed: Column) -> list[Column]:
    """Both halves of hashes, summed: equal for equal sets, whatever their order."""
    return [F.sum(F.shiftright(hashed, 32)), F.sum(hashed.bitwiseAND(0xFFFFFFFF))]


def classes(outline: DataFrame) -> DataFrame:
    """Per host the tokens of its template: token, parent, vector (the class), pages, kind, ...

    Classes that are out of order, or not nested in one class, are left out.
    """
    high, low = _sums(F.xxhash64("page", "n"))
    tokens = outline.groupBy("host", "token").agg(
        high.alias("high"),
        low.alias("low"),
        F.count("*").alias("pages"),
        F.max("n").alias("most"),
        F.sum("chars").alias("chars"),
        *[F.min(c).alias(c) for c in ("parent", "depth", "kind")],
    )
    tokens = tokens.withColumn("vector", F.xxhash64("high", "low", "pages")).drop("high", "low")
    hosts = tokens.groupBy("host").agg(F.max("pages").alias("host_pages"), F.max("chars").alias("host_chars"))
    tokens = materialize(join_unique(tokens, hosts, ["host"], "inner").filter("2 * pages >= host_pages"), "template-tokens")

    seen = outline.select("host", "page", "token", "first", "last").join(
        tokens.select("host", "token", "vector"), ["host", "token"]
    )
    by = lambda place: F.xxhash64(
        F.transform(F.array_sort(F.collect_set(F.struct(place, "token"))), lambda x: x["token"])
    )
    orders = seen.groupBy("host", "vector", "page").agg(by("first").alias("first"), by("last").alias("last"))
    ordered = orders.groupBy("host", "vector").agg(
        ((F.min("first") == F.max("first")) & (F.min("last") == F.max("last"))).alias("ordered")
    )
    parents = tokens.select("host", F.col("token").alias("parent"), F.col("vector").alias("outer"))
    nested = (
        tokens.join(parents, ["host", "parent"], "left")
        .filter(~F.col("outer").eqNullSafe(F.col("vector")))
        .groupBy("host", "vector")
        .agg((F.count_distinct(F.coalesce("outer", F.lit(0))) > 1).alias("astray"))
    )
    valid = ordered.filter("ordered").join(nested, ["host", "vector"], "left").filter(~F.coalesce("astray", F.lit(False)))
    return tokens.join(valid.select("host", "vector"), ["host", "vector"])


def templates(tokens: DataFrame) -> DataFrame:
    """Per host the paths whose slots hold the article, and the texts that belong to the template.

    A row is bounded by twice the tokens of a page, as half of the pages bear each token.
    """
    of = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("token")))
    holds = (F.col("kind") == PLAIN) & (F.col("most") == 1) & (100 * F.col("chars") >= MOST_PERCENT * F.col("host_chars"))
    # The text of a few pages may agree without being the template's.
    fixed = (F.col("kind") == TEXT) & (F.col("host_pages") > 2) & (F.col("pages") == F.col("host_pages"))
    found = tokens.groupBy("host").agg(
        of(IN_ARTICLE).alias("articles"),
        of(IN_MAIN).alias("mains"),
        F.max_by(F.when(holds, F.col("token")), F.when(holds, F.col("depth"))).alias("held"),
        F.collect_set(F.when(fixed, F.col("token"))).alias("texts"),
    )
    named = F.when(F.size("articles") > 0, F.col("articles")).otherwise(F.col("mains"))
    return found.select(
        "host",
        F.when(F.size(named) > 0, named).otherwise(F.array_compact(F.array("held"))).alias("slots"),
        F.when(F.size(named) > 0, F.array().cast("array<bigint>")).otherwise(F.col("texts")).alias("fixed"),
    )


def article(html: str | None, slots: list[int] | None, fixed: list[int] | None) -> str:
    """The blocks of a page that fill the slots, one to a line."""
    page = _read(html)
    inside = page.inside(set(slots or ()))
    blocks = [b for b in page.blocks if b.within in inside]
    if not inside:
        kinds = {b.article for b in page.blocks}
        kind = ARTICLE if ARTICLE in kinds else MAIN if MAIN in kinds else ""
        blocks = [b for b in page.blocks if b.article == kind] if kind else page.blocks
        fixed = None if kind else fixed
    template = set(fixed or ())
    kept = [b for b in blocks if b.token not in template] if template else blocks
    return "\n".join(b.text for b in kept or blocks)


def _rows(*columns: pa.Array) -> dict:
    *keys, html, slots, fixed = columns
    texts = [article(*row) for row in zip(html.to_pylist(), slots.to_pylist(), fixed.to_pylist())]
    return {f"k{i}": k for i, k in enumerate(keys)} | {
        "text": pa.array(texts, pa.string()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
    }


def _with_templates(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Templates by host, sent to all tasks only if their measured size allows it."""
    size = found.agg(F.sum(64 + 8 * (F.size("slots") + F.size("fixed"))).alias("n")).first()["n"] or 0
    return pages.join(F.broadcast(found) if size <= SENT_BYTES else found, "host", "left")


def extract(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Per page: key, url, text and n_chars."""
    found = materialize(templates(classes(materialize(outlines(pages, url, html), "outlines"))), "templates")
    named = pages.select(
        F.col(f"`{key}`").alias("k0"),
        F.col(f"`{url}`").alias("k1"),
        host_of(F.col(f"`{url}`")).alias("host"),
        F.col(f"`{html}`").alias("h"),
    )
    types = dict(pages.dtypes)
    schema = f"k0 {types[key]}, k1 {types[url]}, text string, n_chars bigint"
    out = map_rows(_with_templates(named, found), ["k0", "k1", "h", "slots", "fixed"], schema, _rows)
    return out.withColumnsRenamed({"k0": key, "k1": url})
