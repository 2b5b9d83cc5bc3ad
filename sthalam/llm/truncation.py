"""Texts that were cut off: right-censored lengths of each source, combined with how the text ends."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sthalam.session import cut_lineage

#: A length is a candidate limit where at least this share of a source's texts have it, and this many times the texts of the lengths around it.
LIMIT_SHARE, LIMIT_EXCESS = 0.01, 4.0
#: Share of all distinct texts that end by a line of one form, from which on that line is a way to close a text.
CLOSING_SHARE = 0.001
#: Share of texts cut off at any length (in transfer), before the evidence.
TRANSFER_PRIOR = 0.03
#: How far below a limit in bytes a cut text may end, since a letter isn't split.
BYTE_SLACK = 3
WORDS = regex.compile(r"[\p{L}\p{M}]+|\d+(?:[.,/]\d+)*|[.!?।॥…]+|\n")
_ASCII_WORDS = re.compile(r"[A-Za-z]+|[0-9]+(?:[.,/][0-9]+)*|[.!?]+|\n")  # the same for a text of ASCII letters
STOPS = set(".!?।॥…")
_HIDDEN, _LINES, _BLANKS, _EDGES = regex.compile("[​‌‍﻿­]"), regex.compile("\r\n?"), regex.compile("[\t  -  　 ]+"), regex.compile(" *\n[ \n]*")
_X, _NAME, _FIGURES, _ENDFIGURES, _FULL = regex.compile(r"\bX\b"), regex.compile(r"\p{Lu}[\p{L}\p{M}]+"), regex.compile(r"\d+"), regex.compile(r"\d*$"), regex.compile(r"[.!?।॥…][\"'”’)\]]*$")
#: Word groups that a worker counts before it hands the counts on, and words whose masked forms it keeps.
GROUPS, KEPT = 200_000, 300_000


def smooth(text: str) -> str:
    """One kind of blank and line end, nothing invisible, no outer blanks."""
    x = text
    plain = x.isascii()
    if not plain:
        x = _HIDDEN.sub("", x)
    if "\r" in x:
        x = _LINES.sub("\n", x)
    if not plain or "  " in x or "\t" in x:
        x = _BLANKS.sub(" ", x)
    if "\n" in x:
        x = _EDGES.sub("\n", x)
    return x.strip(" \n")


def words_of(text: str) -> list[str]:
    return (_ASCII_WORDS if text.isascii() else WORDS).findall(text)


class _Masks(dict):
    """Figures by their shape, capitalised words as X, stops as one, others in their letters."""

    def __missing__(self, w: str) -> str:
        if len(self) > KEPT:
            self.clear()
        x = self[w] = "." if w[0] in STOPS else _FIGURES.sub("0", w) if w[0].isdecimal() else "X" if w[0].isupper() else w
        return x


def _ending(text: str, w: list[str]) -> tuple:
    """(form of the last line, length of its last figures, mark, has_stop, a, b, c, figure, stopped) of a smoothed text with the masked words w."""
    more = "\n" in text
    last = text.rsplit("\n", 1)[-1]
    form = None
    if more:
        named = _NAME.sub("X", last)
        form = _FIGURES.sub("0", named if len(_X.findall(named)) >= 3 else last)
    stop = w[-1] == "."
    core = ["^", "^", "^", *(w[-4:-1] if stop else w[-3:])]
    full = bool(_FULL.search(text[-200:]))
    return form, len(_ENDFIGURES.search(last)[0]), hashlib.md5(text.encode()).digest(), stop, *core[-3:], full and text[-1] == "." and text[-2:-1].isdecimal(), full


ENDING = "form string, figures int, mark binary, has_stop boolean, a string, b string, c string, figure boolean, stopped boolean"


def read_texts(documents: DataFrame) -> DataFrame:
    """One pass over `documents` (k, named, text), with two sorts of rows: `n` null: a text (k, named, chars, bytes and its ENDING, null without words);
    else how often the words a, b, c were followed by more of the text (n), and by a full stop or line end (stop), in some of the texts.

    The groups are counted before they leave the worker, GROUPS at a time.
    """
    schema = f"k {documents.schema['k'].dataType.simpleString()}, named string, chars bigint, bytes bigint, {ENDING}, n bigint, stop bigint"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def batch(columns: dict[str, list], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, counts = _Masks(), Counter()

        def counted() -> pa.RecordBatch:
            both: dict[tuple, list[int]] = {}
            for (a, b, c, stop), n in counts.items():
                if c not in (".", "\n"):
                    x = both.setdefault((a, b, c), [0, 0])
                    x[0] += n
                    x[1] += n * stop
            counts.clear()
            return batch({**{x: [g[i] for g in both] for i, x in enumerate("abc")}, "n": [x[0] for x in both.values()], "stop": [x[1] for x in both.values()]}, len(both))

        for t in batches:
            rows = []
            for text in t.column("text").to_pylist():
                text = text or ""
                even = smooth(text)
                w = [masks[x] for x in words_of(even)]
                rows.append((len(text), len(text.encode()), *(_ending(even, w) if w else (None,) * 9)))
                if len(w) > 1:
                    counts.update(zip(["^", "^", *w], ["^", *w], w, [x in (".", "\n") for x in w[1:]], strict=False))
                if len(counts) > GROUPS:
                    yield counted()
            names = ["chars", "bytes", *(x.split()[0] for x in ENDING.split(", "))]
            made = dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {}
            yield batch({"k": t.column("k"), "named": t.column("named"), **{k: list(v) for k, v in made.items()}}, t.num_rows)
        yield counted()

    return documents.mapInArrow(run, schema)


def candidate_limits(lengths: DataFrame) -> DataFrame:
    """(source, unit, at, n, total): lengths at which a source's texts pile up, of `lengths` (source, unit, length, n)."""
    total = Window.partitionBy("source", "unit")
    # the neighbourhood: a tenth of the length to either side, but for the length itself
    near = Window.partitionBy("source", "unit").orderBy("length").rangeBetween(-40, 40)
    x = lengths.withColumn("total", F.sum("n").over(total)).withColumn("around", (F.sum("n").over(near) - F.col("n")) / 80.0)
    x = x.where((F.col("n") >= LIMIT_SHARE * F.col("total")) & (F.col("n") >= LIMIT_EXCESS * (F.col("around") + 1)))
    return x.select("source", "unit", F.col("length").alias("at"), "n", "total", "around")


def fit_censored(n: float, total: float, squares: float, censored: list[tuple[float, float]]) -> tuple[float, float]:
    """Mean and deviation of a normal distribution by maximum likelihood (EM), from the count, sum and sum of squares of the
    values seen and (limit, count) of those known only to be at least their limit."""
    seen = max(n, 1e-9)
    mu = total / seen
    sd = math.sqrt(max(squares / seen - mu * mu, 1e-4))
    every = n + sum(c for _, c in censored)
    for _ in range(500):
        s, q = total, squares
        for limit, c in censored:
            z = (limit - mu) / sd
            tail = 0.5 * math.erfc(z / math.sqrt(2))
            hazard = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) / tail if tail > 1e-12 else z + 1 / max(z, 1)
            mean = mu + sd * hazard
            s += c * mean
            q += c * (sd * sd * (1 + z * hazard - hazard * hazard) + mean * mean)
        new_mu = s / max(every, 1e-9)
        new_sd = math.sqrt(max(q / max(every, 1e-9) - new_mu * new_mu, 1e-4))
        done = abs(new_mu - mu) + abs(new_sd - sd) < 1e-7
        mu, sd = new_mu, new_sd
        if done:
            break
    return mu, sd


def censoring(docs: DataFrame) -> DataFrame:
    """(source, unit, at, posterior, mu, sigma): for each candidate limit the probability that a text that ends there was cut by it.

    `docs` has (source, chars, bytes, mark). The lengths' logarithms of a source and unit are taken as normal. Texts at a limit count as censored; the fitted
    curve tells how many would have that length of themselves, the rest of those there were cut. Each source and unit is fitted by a worker, from its sums and its
    limits (a limit holds LIMIT_SHARE of its source at least, so there are at most 1 / LIMIT_SHARE), so any number of sources will do. Copies of a text count
    once, so that a text delivered over and over doesn't make its own length a limit.
    """
    docs = docs.select("source", "chars", "bytes", "mark").distinct()
    lengths = docs.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("x")).select("source", "x.unit", "x.length")
    lengths = cut_lineage(lengths.where("length > 0").groupBy("source", "unit", "length").agg(F.count("*").alias("n")))
    limits = cut_lineage(candidate_limits(lengths))
    log = F.log("length")
    free = lengths.join(limits.select("source", "unit", F.col("at").alias("length"), F.lit(True).alias("held")), ["source", "unit", "length"], "left").where("held IS NULL")
    sums = free.join(limits.select("source", "unit").distinct(), ["source", "unit"], "left_semi").groupBy("source", "unit").agg(F.sum("n").alias("seen"), F.sum(F.col("n") * log).alias("s"), F.sum(F.col("n") * log * log).alias("q"))
    found = limits.groupBy("source", "unit").agg(F.collect_list(F.struct("at", "n", "total", "around")).alias("limits")).join(sums, ["source", "unit"], "left")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            out = []
            for r in t.itertuples():
                at = sorted(r.limits, key=lambda x: x["at"])
                if r.seen is None or r.seen != r.seen:
                    mu, sd = math.log(at[0]["at"]), 1.0
                else:
                    mu, sd = fit_censored(r.seen, r.s, r.q, [(math.log(x["at"]), x["n"]) for x in at])
                for x in at:
                    z = (math.log(x["at"]) - mu) / sd
                    natural = x["total"] * math.exp(-z * z / 2) / (sd * math.sqrt(2 * math.pi) * x["at"])
                    cut = 1 - min(0.95, max(natural, float(x["around"])) / x["n"])
                    out.append((r.source, r.unit, x["at"], float(min(0.995, max(0.05, cut))), mu, sd))
            yield pd.DataFrame(out, columns=["source", "unit", "at", "posterior", "mu", "sigma"])

    return found.mapInPandas(fit, "source string, unit string, at bigint, posterior double, mu double, sigma double")


def truncated(documents: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(`key`, source, length, at_limit, p_limit, p_stop, closing, score, truncated): one row for each row of `documents`.

    The prior is the censoring posterior of the limit at which the text ends, else TRANSFER_PRIOR. The evidence is how often,
    over the whole corpus, the text's last words are followed by a full stop or line end rather than by further words
    (three words back, or fewer where three were never seen further inside a text; a last word that was seen nowhere is broken
    off); a full stop of its own; and a last line of a form with which CLOSING_SHARE of all distinct texts close, learned from those that
    don't end at a candidate limit: how often its last figures are as long as here rather than longer. A text is taken as
    truncated where prior and evidence together favour it. Null, empty and blank texts aren't truncated; a null source is a source of its own;
    repeated rows come out as often as they go in; other columns aren't read. Whole texts are read and all documents counted.
    """
    d = documents.select(F.col(f"`{key}`").alias("k"), F.col(f"`{source}`").alias("named"), F.col(f"`{text}`").alias("text"))
    read = cut_lineage(read_texts(d))
    texts = read.where("n IS NULL").drop("n", "stop").withColumn("source", F.coalesce("named", F.lit("")))

    # what follows each three words, over all texts; shorter contexts are summed from these counts
    three = cut_lineage(read.where("n IS NOT NULL").groupBy("a", "b", "c").agg(F.sum("n").alias("n"), F.sum("stop").alias("stop")))
    two = three.groupBy("b", "c").agg(F.sum("n").alias("n2"), F.sum("stop").alias("stop2"))
    one = three.groupBy("c").agg(F.sum("n").alias("n1"), F.sum("stop").alias("stop1"))

    # the limit at which a text ends: equal lengths in characters, or in bytes up to BYTE_SLACK below; lengths first reduced to the distinct ones
    ends = texts.where("mark IS NOT NULL")
    limits = cut_lineage(censoring(texts.where("chars > 0").withColumn("mark", F.coalesce("mark", F.lit("").cast("binary")))))
    slack = F.when(F.col("unit") == "bytes", F.sequence(F.col("at") - BYTE_SLACK, F.col("at"))).otherwise(F.array("at"))
    near = limits.select("source", "unit", F.explode(slack).alias("length"), F.struct("posterior", "at", "unit").alias("hit"))
    by = lambda unit: near.where(F.col("unit") == unit).groupBy("source", F.col("length").alias(unit)).agg(F.max("hit").alias(f"hit_{unit}"))
    sizes = ends.select("source", "chars", "bytes").distinct().join(by("chars"), ["source", "chars"], "left").join(by("bytes"), ["source", "bytes"], "left")
    hit = sizes.withColumn("hit", F.greatest("hit_chars", "hit_bytes")).where("hit IS NOT NULL").select("source", "chars", "bytes", F.col("hit.at").alias("at_limit"), F.col("hit.posterior").alias("p_limit"))

    e = cut_lineage(ends.join(hit, ["source", "chars", "bytes"], "left"))
    # the ways to close a text, by the length of the figures at their end
    total = e.select("mark").distinct().count()
    lines = e.where("form IS NOT NULL AND at_limit IS NULL").select("form", "figures", "mark").distinct().groupBy("form", "figures").agg(F.count("*").alias("times"))
    closing = lines.groupBy("form").agg(F.sum("times").alias("times"), F.collect_list(F.struct("figures", "times")).alias("closing")).where(F.col("times") >= max(3, CLOSING_SHARE * total)).drop("times")
    # rows without a closing line are spread by their mark, so that they aren't one key
    e = e.withColumn("form", F.coalesce("form", F.concat(F.lit("\n"), F.hex("mark")))).join(closing, "form", "left")
    last = e.select("a", "b", "c").distinct().join(three, ["a", "b", "c"], "left").join(two, ["b", "c"], "left").join(one, ["c"], "left")
    e = e.join(cut_lineage(last), ["a", "b", "c"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    ratio = lambda s, n: (z(s) + 0.02) / (z(n) + 1.0)
    p_stop = F.when(z("n") >= 3, ratio("stop", "n")).when(z("n2") >= 3, ratio("stop2", "n2")).when(z("n1") >= 3, F.least(ratio("stop1", "n1"), F.lit(0.3))).otherwise(F.lit(0.02))
    seen = lambda fit: F.aggregate(F.filter("closing", lambda x: fit(x["figures"], F.col("figures"))), F.lit(0).cast("bigint"), lambda n, x: n + x["times"])
    same, longer = seen(lambda x, own: x == own), seen(lambda x, own: x > own)
    e = e.withColumn("p_stop", p_stop).withColumn("p_close", (same + 1) / (same + longer + 1)).withColumn("closed", F.col("closing").isNotNull())
    prior = F.coalesce("p_limit", F.lit(TRANSFER_PRIOR))
    clip = lambda p: F.greatest(F.lit(0.002), F.least(F.lit(0.998), p))
    # log of how much likelier this end is in a cut text than in a whole one
    figure = F.col("figure") & (F.col("b") != "X") & (z("n2") >= 3) & (ratio("stop2", "n2") < 0.02)
    odds = lambda p: F.log((1 - clip(p)) / clip(p))
    whole = F.when(F.col("closed"), F.when(F.col("stopped") & F.col("has_stop"), F.lit(-9.0)).otherwise(odds(F.col("p_close")))).when(F.col("stopped") & F.col("has_stop"), F.when(figure, F.lit(4.5)).otherwise(F.lit(-9.0)))
    evidence = F.coalesce(whole, odds(F.col("p_stop")) + 2.0)
    e = e.withColumn("score", F.log(prior / (1 - prior)) + evidence)
    rows = e.select(F.col("k").alias(key), F.col("named").alias("source"), F.col("chars").alias("length"), "at_limit", "p_limit", "p_stop", F.col("closed").alias("closing"), "score", (F.col("score") > 0).alias("truncated"))
    none = texts.where("mark IS NULL").select(F.col("k").alias(key), F.col("named").alias("source"), F.col("chars").alias("length"))
    return rows.unionByName(none.withColumn("closing", F.lit(False)).withColumn("truncated", F.lit(False)), allowMissingColumns=True)


def truncation_report(found: DataFrame) -> DataFrame:
    """(source, documents, truncated, share): how often each source cuts its texts off."""
    r = found.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("truncated").cast("bigint")).alias("truncated"))
    return r.withColumn("share", F.round(F.col("truncated") / F.col("documents"), 6))
