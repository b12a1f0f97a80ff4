"""Quality rules with thresholds read from the data itself, in DataFrame functions only.

Every document gets counts (words, symbols, repeated lines, repeated word windows).  Four ratios
of them are summarised per language and source in mergeable quantile sketches: a value is rounded
up to its cell (CELL_BITS = 6 significant bits: relative error under 1/32) and a sketch is the count per cell.
Cells of two sketches add up, so map tasks combine before the shuffle, a hot source is a few
hundred rows, and the sketch of a language, or of everything, is the sum of its sources' cells.

The fences are `quartile 3 + SPREADS * spread` and, for the word length, also
`quartile 1 - SPREADS * spread`, where spread is the quartile distance but at least a floor per
ratio (so a group whose values are all equal does not reject the first different document).  A
group with fewer than MIN_GROUP documents uses its language's fences, a small language the fences
of all documents.  Documents failing the fixed base rule do not enter the sketches.

Defined results: a null or blank text has no words, fails the base rule and is not kept; null
language or source is a group of its own; repeated rows count each; an empty table gives an empty
result; other columns, whatever their names, are passed through by `filter_documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.llm.common import NOT_SPACE, words, write_table

MIN_WORDS = 50
MIN_GROUP = 20
SPREADS = 4
#: ratio -> (expression over the counts, floor of the spread, has a lower fence)
RATIOS = {
    "word_len": ("100 * word_chars div n_words", 50, True),
    "symbols": ("10000 * n_symbols div word_chars", 100, False),
    "dup_lines": ("10000 * n_dup_lines div n_lines", 1000, False),
    "repeats": ("10000 * n_repeat_words div n_words", 1000, False),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
CELL_BITS = 6


def document_counts(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (default: all but clashing ones) plus COUNTS and base_failed, per row.

    The stages are separate projections on purpose: each array is computed once and read by
    several expressions of the next stage.
    """
    keep = [c for c in (docs.columns if keep is None else keep)
            if c.lower() not in {x.lower() for x in [*COUNTS, "base_failed"]}]
    text = F.coalesce(docs[text_col], F.lit(""))
    kept = F.struct(*[docs[c] for c in keep]) if keep else F.struct(F.lit(0).alias("_"))
    a = docs.select(kept.alias("d"), text.alias("t"), words(docs[text_col]).alias("w"))
    b = a.select(
        "d", "w",
        F.expr("cast(size(w) as bigint)").alias("n_words"),
        (F.length("t") - F.length(F.regexp_replace("t", NOT_SPACE, ""))).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.expr(r"filter(split(t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
        F.expr("case when size(w) >= 3 then transform(sequence(0, size(w) - 3), "
               "i -> xxhash64(w[i], w[i + 1], w[i + 2])) else array() end").alias("h"))
    c = b.select(
        "d", "n_words", "word_chars", "n_symbols",
        F.expr("cast(size(lines) as bigint)").alias("n_lines"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)").alias("n_dup_lines"),
        # only texts with a repeated window are sorted: (hash, position), equal hashes adjacent
        F.expr("case when size(array_distinct(h)) < size(h) then "
               "sort_array(transform(h, (x, i) -> struct(x as h, i as i))) end").alias("s"))
    e = c.select("*", F.expr(
        "sort_array(transform(filter(transform(s, (x, k) -> struct("
        "  (k > 0 and get(s, k - 1).h = x.h) or (k + 1 < size(s) and get(s, k + 1).h = x.h) as hit, x.i as i)),"
        " y -> y.hit), y -> y.i))").alias("p"))
    # a window covers its three words; the next window's start cuts it short
    repeat = F.expr("case when p is null or size(p) = 0 then 0L else aggregate("
                    "transform(p, (x, k) -> case when k + 1 < size(p) then least(3, get(p, k + 1) - x) else 3 end), "
                    "0L, (acc, x) -> acc + x) end")
    f = e.select("d", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                 repeat.alias("n_repeat_words"))
    return f.select(
        *[F.col("d").getField(c).alias(c) for c in keep], *COUNTS,
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"))


def cell(v):
    """Upper end of the sketch cell of a whole number >= 0: its leading bits, the rest set."""
    shift = f"greatest(length(bin({v})) - {CELL_BITS}, 0)"
    return f"(shiftleft(shiftright({v}, {shift}) + 1, {shift}) - 1)"


def sketches(counts: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, ratio, cell, n): one mergeable quantile sketch per group and ratio."""
    pairs = ", ".join(f"'{name}', cast({expr} as bigint)" for name, (expr, _, _) in RATIOS.items())
    return (counts.filter("not base_failed")
            .select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                    F.expr(f"stack({len(RATIOS)}, {pairs}) as (ratio, v)"))
            .select("lang", "source", "ratio", F.expr(cell("v")).alias("cell"))
            .groupBy("lang", "source", "ratio", "cell").agg(F.count("*").alias("n")))


def _quartiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles of each sketch; a group has a few hundred cells at most, whatever its rows."""
    from pyspark.sql import Window
    merged = cells.groupBy(*keys, "ratio", "cell").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "ratio")
    run = merged.select("*", F.sum("n").over(w.orderBy("cell")).alias("upto"), F.sum("n").over(w).alias("total"))
    return run.groupBy(*keys, "ratio").agg(
        F.max("total").alias("docs"),
        F.min(F.expr("case when 4 * upto >= total then cell end")).alias("q1"),
        F.min(F.expr("case when 4 * upto >= 3 * total then cell end")).alias("q3"))


def fences(cells: DataFrame, min_group: int = MIN_GROUP, spreads: int = SPREADS) -> DataFrame:
    """One row per (lang, source): columns `<ratio>_low` (null: none) and `<ratio>_high`."""
    own = _quartiles(cells, ["lang", "source"]).alias("o")
    by_lang = _quartiles(cells, ["lang"]).alias("l")
    whole = _quartiles(cells, []).alias("a")
    pick = lambda c: F.expr(
        f"case when o.docs >= {min_group} then o.{c} when l.docs >= {min_group} then l.{c} else a.{c} end")
    joined = (own.join(by_lang, F.expr("o.lang <=> l.lang and o.ratio = l.ratio"))
              .join(whole, F.expr("o.ratio = a.ratio"))
              .select(F.col("o.lang"), F.col("o.source"), F.col("o.ratio"),
                      pick("q1").alias("q1"), pick("q3").alias("q3")))
    out = []
    for name, (_, floor, two_sided) in RATIOS.items():
        spread = f"{spreads} * greatest(q3 - q1, {floor})"
        out.append(F.max(F.expr(f"case when ratio = '{name}' then q3 + {spread} end")).alias(f"{name}_high"))
        if two_sided:
            out.append(F.max(F.expr(f"case when ratio = '{name}' then q1 - {spread} end")).alias(f"{name}_low"))
    return joined.groupBy("lang", "source").agg(*out)


def judge(counts: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """`counts` plus boolean `kept`.  The fences are read from a small written table, so the
    planner sees its size and joins by broadcast, or by a skew-splitting join when it is large."""
    f = limits.select(F.struct(*limits.columns).alias("_fence"))
    joined = counts.join(f, counts[lang_col].eqNullSafe(f["_fence.lang"])
                         & counts[source_col].eqNullSafe(f["_fence.source"]), "left")
    ok = F.lit(True)
    for name, (expr, _, two_sided) in RATIOS.items():
        ok = ok & F.expr(f"{expr} <= _fence.{name}_high")
        if two_sided:
            ok = ok & F.expr(f"{expr} >= _fence.{name}_low")
    kept = F.when(F.col("base_failed"), False).otherwise(F.coalesce(ok, F.lit(False)))
    return joined.withColumn("kept", kept).drop("_fence")


def quality_verdicts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Counts and verdict per row; `keep` columns (default: all but the text) come along.

    The counts are written once as a narrow table; sketches and verdicts both read it.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c != text_col]
    counts = write_table(document_counts(docs, text_col, [*dict.fromkeys([*keep, lang_col, source_col])]),
                         "quality-counts")
    limits = write_table(fences(sketches(counts, lang_col, source_col)), "quality-fences")
    return judge(counts, limits, lang_col, source_col).select(*keep, *COUNTS, "base_failed", "kept")


def filter_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source") -> DataFrame:
    """The rows of `docs` that are kept, with their own columns.

    Two passes over the texts: one for the sketches, one that judges each row in place, so texts
    are never joined by an id and repeated ids are harmless."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    wrapped = docs.select(row, docs[text_col].alias("_text"), docs[lang_col].alias("_lang"),
                          docs[source_col].alias("_source"))
    # written: a filter over the unwritten counts would be pushed down and repeat their expressions
    first = write_table(document_counts(wrapped, "_text", ["_lang", "_source"]), "quality-counts")
    limits = write_table(fences(sketches(first, "_lang", "_source")), "quality-fences")
    counts = document_counts(wrapped, "_text", ["_row", "_lang", "_source"])
    return judge(counts, limits, "_lang", "_source").filter("kept").select("_row.*")
