"""HTML extraction by consensus host paths (operator 9).

Each page is read twice. First its containers are scored: the best is the
smallest one that holds four fifths of the text outside links, menus, headers,
footers, sidebars, notices, adverts, forms and comments. From there it widens to
the outermost container whose further text is still of the article (an enclosing
article element, or blocks that are neither set apart nor links), so that title,
lead and closing parts beside a dense container stay. The page votes for that
container's generalised path (tags and classes from the root, numbers as ``#``).
Spark counts the votes per host and path (map-side combined, so a host with any
share of the pages is no hot key) and takes the most voted path of each host,
ties by score, then by path; the paths that stand beside it on a tenth of its
voters are known to be no article there. Then every page's text is taken from all
containers at its host's path, in page order, or from the page's own best one
where it has none there, or where these hold less than half as much text as the
best one does (without what is known to stand beside): a page of another layout.

Words in a class or id ("notice", "share", "widget", ...) decide nothing by
themselves: the text of an element with such a word is left out if it is mostly
links, if a tenth of the host's pages (three at least) have the very same text there,
or if it is a box outside the place of the article. Only words that plainly name an
advert, comments, a cookie bar or the like, alone in their class but for words of
layout, need no more, and not against half of a page's text.

What a host's pages agree on is broadcast while it is small (``BROADCAST_BYTES``,
measured); beyond, it is copied to ``SALTS`` salts, over which a host's pages are
dealt, so that a host with a third of all pages is no one task's work.

Blocks are joined by line feeds in page order; white space inside a block is one
space; character references are decoded. Nothing is capped.

Defined cases: a null or empty page, or one without text, gives the empty text;
a null or unusual URL has the empty host; repeated rows and ids each give a row;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import mapped, pinned
from ._html import article_text, page_votes

BROADCAST_BYTES, SALTS, LEAST_REPEATS = 4 << 20, 16, 3


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, path, pages, beside, repeated)``: the winning path of each host, its
    votes, the paths that stand beside it on a tenth or more of the pages that voted for
    it, and hashes of texts that a tenth of the host's pages have."""

    def votes(batches):
        types = (pa.string(), pa.int64(), pa.string(), pa.int64())
        for b in batches:
            rows, found = [], []
            for i, h in enumerate(b.column(1).to_pylist()):
                v, weak = page_votes(h) if h else (None, [])
                mine = [(None, 0, None, None), *((None, 0, None, w) for w in weak)]
                if v:
                    mine += [(v[0], v[1], None, None), *((v[0], 0, p, None) for p in v[2])]
                found += mine
                rows += [i] * len(mine)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), *(pa.array([f[k] for f in found], t) for k, t in enumerate(types))],
                names=["host", "path", "score", "beside", "weak"],
            )

    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    counted = mapped(rows, votes, "host string, path string, score long, beside string, weak long")
    # Repeated texts are grouped first: most occur once and go no further.
    counted = counted.groupBy("host", "path", "beside", "weak").agg(F.count("*").alias("pages"), F.sum("score").alias("score"))
    counted = pinned(counted.where(f"weak IS NULL OR pages >= {LEAST_REPEATS}"))
    won = counted.where("beside IS NULL AND path IS NOT NULL").groupBy("host").agg(F.max(F.struct("pages", "score", "path")).alias("w")).select("host", "w.path", "w.pages")
    # At most ten times as many paths, and texts, a host as its pages have on average.
    near = counted.where("beside IS NOT NULL").select("host", "path", "beside", F.col("pages").alias("n")).join(won, ["host", "path"]).where("n * 10 >= pages")
    near = near.groupBy("host").agg(F.sort_array(F.collect_list("beside")).alias("beside"))
    every = counted.where("path IS NULL AND weak IS NULL").select("host", F.col("pages").alias("all"))
    again = counted.where("weak IS NOT NULL").select("host", "weak", F.col("pages").alias("n")).join(every, "host").where("n * 10 >= all")
    again = again.groupBy("host").agg(F.sort_array(F.collect_list("weak")).alias("repeated"))
    agreed = every.select("host").join(won, "host", "left").join(near, "host", "left").join(again, "host", "left")
    return agreed.where("path IS NOT NULL OR repeated IS NOT NULL").select(
        "host", "path", "pages", F.coalesce("beside", F.array().cast("array<string>")).alias("beside"), F.coalesce("repeated", F.array().cast("array<long>")).alias("repeated")
    )


def extract_articles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(<id_col>, <url_col>, text, n_chars)`` for every row of ``pages``."""
    paths = pinned(host_paths(pages, url_col, html_col)).select(F.col("host").alias("h"), "path", "beside", "repeated")
    size = F.octet_length("h") + F.coalesce(F.octet_length("path"), F.lit(0)) + F.octet_length(F.concat_ws("", "beside")) + 8 * F.size("repeated") + 64
    small = (paths.agg(F.sum(size.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("h"))
    if small:
        joined = rows.join(F.broadcast(paths), "h", "left")
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
        joined = rows.join(paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["h", "salt"], "left")
    joined = joined.select("id", "url", "html", "path", "beside", "repeated")
    id_type = joined.schema["id"].dataType.simpleString()

    def texts(batches):
        for b in batches:
            out = [article_text(h, p, n or (), r or ()) if h else "" for h, p, n, r in zip(*(b.column(c).to_pylist() for c in (2, 3, 4, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["id", "url", "text", "n_chars"]
            )

    done = mapped(joined, texts, f"id {id_type}, url string, text string, n_chars long")
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
