"""Divergence of sources: shares of terms by language and source, compared in whole numbers, ranked by count cells."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import release, staged
from .words import LOWER, NOT_LETTER

#: Distinct terms that a task counts before it gives them out, and bytes of a text that are split at once.
MOST_TERMS, STEP = 300_000, 1 << 20
#: By byte: itself, A-Z in lower case, and a space for what belongs to no term.
TERM_BYTES = np.where(NOT_LETTER, 32, LOWER).astype(np.uint8).tobytes()
COUNTS = "lang string, source string, term string, n long, docs long"


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about STEP bytes, cut at spaces."""
    a = 0
    while a < len(text):
        b = text.find(b" ", a + STEP)
        b = len(text) if b < 0 else b
        yield text[a:b]
        a = b


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents), several times for a term; a row with null term and 0 for each group."""
    n, docs, groups, held = {}, {}, set(), 0

    def flushed() -> pa.RecordBatch:
        nonlocal held
        rows = [(*g, t.decode(), k, docs[g][t]) for g, of in n.items() for t, k in of.items()] + [(*g, None, 0, 0) for g in groups]
        n.clear(), docs.clear(), groups.clear()
        held = 0
        columns = [*zip(*rows, strict=True)] or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string()] * 3 + [pa.int64()] * 2, strict=True)], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for text, *group in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            g = tuple(x or "" for x in group)
            if g not in groups:
                groups.add(g)
                n[g], docs[g] = Counter(), Counter()
            seen: set[bytes] = set()
            known = len(n[g])
            for part in _parts((text.as_py() or "").encode().translate(TERM_BYTES)):
                terms = part.split()
                n[g].update(terms)
                seen.update(terms)
            docs[g].update(seen)
            held += len(n[g]) - known
            if held > MOST_TERMS:
                yield flushed()
    yield flushed()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * terms)) in whole numbers; null without terms."""
    whole = lambda c: c.cast("decimal(38,0)")
    top, below = F.lit(10**9).cast("decimal(10,0)") * (count + 5).cast("decimal(19,0)"), whole(total) + F.lit(5) * terms
    return F.when(terms > 0, F.call_function("div", whole(top), whole(below)) + 1)


def kept_terms(docs: DataFrame, least_docs: int) -> tuple[DataFrame, DataFrame]:
    """Written tables: (lang, source, term, n, c) of the terms kept, n times in the group and c in the language; and
    (lang, source, total, lang_total, terms) of every group."""
    x = docs.select(*(F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")))
    counts = x.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = staged(counts, "terms")
    of_lang = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("c"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = staged(counts.join(of_lang.select("lang", "term", "c"), ["lang", "term"]).select("lang", "source", "term", "n", "c"), "kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.first("c").alias("c")).groupBy("lang").agg(F.sum("c").alias("lang_total"), F.count("*").alias("terms"))
    groups = counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = staged(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "terms"))), "groups")
    release(counts)
    return kept, groups


def term_ranks(kept: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """(lang, source, item, value, rank): each group's terms that it uses more than its language does, by how much more.

    Terms of one count in the group and one in the language make a cell, whose value is reckoned once. Equal values are one
    step; a step's first rank follows from how many terms lie above, and only the terms of the first steps are looked up.
    """
    cells = kept.groupBy("lang", "source", "n", "c").agg(F.count("*").alias("m")).join(groups, ["lang", "source"])
    value = share(F.col("n"), F.col("total"), F.col("terms")) - share(F.col("c"), F.col("lang_total"), F.col("terms"))
    cells = cells.select("lang", "source", "n", "c", "m", value.alias("value")).where("value > 0")
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    steps = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m")).withColumn("_r", F.row_number().over(down)).where(F.col("_r") <= most)
    above = F.coalesce(F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = steps.select("lang", "source", "value", above.alias("above")).where(F.col("above") < most)
    chosen = cells.join(steps, ["lang", "source", "value"]).select("lang", "source", "n", "c", "value", "above")
    named = kept.join(chosen, ["lang", "source", "n", "c"]).select("lang", "source", F.col("term").alias("item"), "value", "above")
    place = F.row_number().over(Window.partitionBy("lang", "source", "value", "above").orderBy("item"))
    named = named.withColumn("_r", place).where(F.col("_r") <= most)
    return named.select("lang", "source", "item", "value", (F.col("above") + F.col("_r")).cast("int").alias("rank")).where(F.col("rank") <= most)


def pair_ranks(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): for each group the other sources of its language, by the sum of differences of shares.

    Cells are pairs of counts in two groups and how many terms have them. Cells of two counts above 0 come from the terms that
    both groups have, added up in the task that joins them; those with a 0 follow from each group's own counts.
    """
    a = groups.select("lang", F.col("source").alias("g"), F.col("total").alias("ng"), "terms")
    b = groups.select("lang", F.col("source").alias("h"), F.col("total").alias("nh"))
    pairs = a.join(b, "lang").where("g < h")  # the rows asked for
    left, right = (kept.select("lang", "term", F.col("source").alias(s), F.col("n").alias(f"c{s}")) for s in ("g", "h"))
    both = left.join(right, ["lang", "term"]).where("g < h").groupBy("lang", "g", "h", "cg", "ch").agg(F.count("*").alias("m"))
    p = lambda count, side: share(count, F.col(f"n{side}"), F.col("terms"))
    zero = F.lit(0).cast("long")
    pg, ph, pg0, ph0 = p(F.col("cg"), "g"), p(F.col("ch"), "h"), p(zero, "g"), p(zero, "h")
    # a term that both have was counted with a 0 on each side by the groups' own counts, and with none by the rest
    joint = F.sum(F.col("m") * (F.abs(pg - ph) - F.abs(pg - ph0) - F.abs(pg0 - ph) + F.abs(pg0 - ph0))).alias("v")
    x = both.join(pairs, ["lang", "g", "h"]).groupBy("lang", "g", "h").agg(joint)
    own = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("m"))
    one = lambda side, pn, other, base: own.select("lang", F.col("source").alias(side), F.col("n").alias(f"c{side}"), "m").join(pairs, ["lang", side]).groupBy("lang", "g", "h").agg(F.sum(F.col("m") * (F.abs(pn - other) - F.abs(pg0 - ph0))).alias("v"))
    x = x.unionByName(one("g", pg, ph0, pg0)).unionByName(one("h", ph, pg0, ph0))
    x = x.unionByName(pairs.select("lang", "g", "h", F.coalesce(F.col("terms") * F.abs(pg0 - ph0), zero).alias("v")))
    x = x.groupBy("lang", "g", "h").agg(F.sum("v").alias("value"))
    turned = [x.select("lang", F.col(s).alias("source"), F.col(o).alias("item"), "value") for s, o in (("g", "h"), ("h", "g"))]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return turned[0].unionByName(turned[1]).withColumn("rank", rank)


def audit(docs: DataFrame, least_docs: int = 30, most: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source's terms differ from the other sources' (part pair, all of
    them) and from its language's (part term, the first ranks).

    Terms are runs of ASCII letters, in lower case, and of characters beyond ASCII; those in at least least_docs documents of a
    language are kept. A share is 1 + floor(10^9 (count + 5) / (total + 5 V)). Null text, lang and source are ''. Repeated
    rows are documents of their own, keys aren't looked at. A language without kept terms has pairs of value 0. Empty
    table: no rows. Counts are added up within tasks before any shuffle, so a source of many documents makes no large group.
    """
    kept, groups = kept_terms(docs, least_docs)
    parts = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, x in (("pair", pair_ranks(kept, groups)), ("term", term_ranks(kept, groups, most)))]
    return parts[0].unionByName(parts[1])


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
tok AS (SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM tok GROUP BY ALL HAVING count(DISTINCT row) >= 30),
n AS (SELECT lang, source, term, count(*) AS n FROM tok GROUP BY ALL),
cell AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, k.c FROM grp g JOIN kept k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
tot AS (SELECT lang, source, sum(n)::HUGEINT AS ng, sum(c)::HUGEINT AS nl, count(*)::HUGEINT AS v FROM cell GROUP BY ALL),
p AS (SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 5)) // (ng + 5 * v) AS BIGINT) AS p, CAST(1 + (1000000000::HUGEINT * (c + 5)) // (nl + 5 * v) AS BIGINT) AS q FROM cell JOIN tot USING (lang, source)),
pair AS (SELECT a.lang, a.source, b.source AS item, abs(a.p - b.p) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce((SELECT sum(f) FROM pair x WHERE x.lang = a.lang AND x.source = a.source AND x.item = b.source), 0) AS BIGINT) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', term, p - q, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INTEGER) AS rank FROM p WHERE n > 0 AND p > q
QUALIFY rank <= 50
"""

QUERIES = {"op13_divergence": op13_divergence}
ORACLES = {"op13_divergence": SQL}
