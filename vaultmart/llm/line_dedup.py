"""Line deduplication within one word edit, in DataFrame functions only.

A line goes if an earlier line (by document id, then line number) has the same words, or, for lines of
at least MIN_WORDS words, differs from it by one word inserted, deleted or replaced.  White space
inside a line does not count; lines without a word always stay.

Equal lines meet in a grouped minimum on a 128-bit key: one row per distinct line, with the place and
the text of its earliest occurrence.  All other occurrences are gone by construction, so the
hottest line is one row, and nothing is joined back.

Near lines meet by their deletion neighbourhoods.  With g(word, position) a 64-bit hash, a line is the
xor of g over its words, and each variant with one word left out follows from running xors:
two lines of n words that differ in word i share the variant (n, i); a line and the same line with
one word more share the longer one's variant and the shorter line itself.  In each group only the
earliest member matters, so a group gives a minimum, never pairs.  A link to it is
verified word by word on the texts.

Two exact pre-filters keep the neighbourhoods small.  A line and one a single edit away share a
whole half (first or last, at the split point of the longer length), so only lines that share a half
with another line emit variants; and of the variants only those that occur twice are grouped with their
places.  Keys that occur twice are marked in a bitmap of fixed size (FILTER_BUCKETS x 4 KB), which is
what is broadcast; a false mark costs work, never a result.

Defined results: null text stays null; a text whose lines all go becomes empty (the row stays); rows that
repeat both id and text are one document, and get the same result; null ids come first; an empty table
gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultmart.llm.common import free_name, scratch, words, write_table

MIN_WORDS = 8
FILTER_BUCKETS = 512
_BITS = FILTER_BUCKETS * 32768  # a bitmap of the built-in functions holds 32768 bits


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, no, line) of `docs` (doc, text): every line of every text."""
    return docs.select("doc", F.posexplode(F.split("text", "\n")).alias("no", "line"))


def _has_word(column):
    return column.rlike(r"[^\x20\x09-\x0D]")


def distinct_lines(docs: DataFrame) -> DataFrame:
    """Written table: one row per distinct line with a word: its key (h1, h2), the place (doc, no) and
    text of its first occurrence, the number of words n and the keys of its halves."""
    joined = F.array_join(words(F.col("line")), " ")
    keyed = _lines(docs).filter(_has_word(F.col("line"))).select("doc", "no", "line", joined.alias("w")).select(
        F.xxhash64("w").alias("h1"), F.xxhash64(F.lit("second"), "w").alias("h2"),
        F.struct("doc", "no", "line").alias("at"))
    first = keyed.groupBy("h1", "h2").agg(F.min("at").alias("at"))
    cut = first.select("h1", "h2", F.struct("at.doc", "at.no").alias("place"), "at.line",
                       words(F.col("at.line")).alias("w")).select("*", F.size("w").alias("n"))

    def half(length: str, start: str, count: str, side: str):
        return F.expr(f"xxhash64('{side}', {length}, array_join(slice(w, {start}, {count}), ' '))")

    halves = F.when(F.col("n") >= MIN_WORDS, F.array(
        half("n", "1", "n div 2", "first"), half("n", "n div 2 + 1", "n - n div 2", "last"),
        half("n + 1", "1", "(n + 1) div 2", "first"),
        half("n + 1", "(n + 1) div 2", "n + 1 - (n + 1) div 2", "last")))
    return write_table(cut.select("h1", "h2", "place", "line", "n", halves.alias("halves")), "lines", "zstd")


def repeated_keys(keys: DataFrame) -> DataFrame:
    """(bucket, bits): the keys of `keys` (key) that occur at least twice, marked in a bitmap."""
    again = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return bitmap(again.select("key"))


def bitmap(keys: DataFrame) -> DataFrame:
    """(bucket, bits): the distinct `keys` (key) marked in a bitmap."""
    marks = keys.select(F.expr(f"pmod(key, {_BITS}) + 1").alias("y"))
    return marks.select(F.bitmap_bucket_number("y").alias("bucket"), F.bitmap_bit_position("y").alias("bit")) \
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def with_mark(df: DataFrame, key_columns: list[str], marks: DataFrame) -> DataFrame:
    """`df` with boolean `marked`: any of the key columns is marked."""
    found = F.lit(False)
    for k, c in enumerate(key_columns):
        y = f"(pmod({c}, {_BITS}) + 1)"
        # broadcast: FILTER_BUCKETS rows of 4 KB at most
        side = F.broadcast(marks.select(F.col("bucket").alias(f"_b{k}"), F.col("bits").alias(f"_m{k}")))
        df = df.join(side, F.expr(f"bitmap_bucket_number({y}) = _b{k}"), "left")
        byte = f"cast(conv(hex(substring(_m{k}, cast(bitmap_bit_position({y}) div 8 as int) + 1, 1)), 16, 10) as int)"
        bit = F.expr(f"shiftright({byte}, cast(bitmap_bit_position({y}) % 8 as int)) & 1")
        found = found | F.coalesce(bit == 1, F.lit(False))
    extra = [f"_{x}{k}" for k in range(len(key_columns)) for x in "bm"]
    return df.withColumn("marked", found).drop(*extra)


def variants(lines: DataFrame) -> DataFrame:
    """Deletion neighbourhoods of `lines` (h1, h2, n, w): (h1, h2, kind, key) with kind `same` (variants for a
    replaced word), `less` (one word deleted) and `full` (the line itself, to meet `less`)."""
    each = lines.select("h1", "h2", "n", F.posexplode("w").alias("i", "word")).select(
        "h1", "h2", "n", "i", F.xxhash64("word", "i").alias("g"), F.expr("xxhash64(word, i - 1)").alias("g_left"))
    whole = Window.partitionBy("h1", "h2")
    run = whole.orderBy("i")
    upto = lambda c, w: F.bit_xor(c).over(w)
    each = each.select("*", upto("g", whole).alias("all"), upto("g", run).alias("g_upto"),
                       upto("g_left", whole).alias("all_left"), upto("g_left", run).alias("left_upto"))
    without = "(g_upto ^ g) ^ (all_left ^ left_upto)"  # words before i in place, those after it one to the left
    keys = [("same", "xxhash64('same', n, i, all ^ g)"), ("less", f"xxhash64('len', n - 1, {without})")]
    rows = ", ".join(f"struct('{kind}' as kind, {key} as key)" for kind, key in keys)
    full = "struct('full' as kind, xxhash64('len', n, all) as key)"
    return each.select("h1", "h2", F.explode(F.expr(
        f"case when i = 0 then array({rows}, {full}) else array({rows}) end")).alias("v")).select(
        "h1", "h2", "v.kind", "v.key")


def _one_edit(a: str, b: str):
    """True if word arrays `a` and `b` differ by exactly one inserted, deleted or replaced word."""
    def gap(longer, shorter):  # first place where they differ, then the rest must agree
        at = f"coalesce(nullif(array_position(zip_with(slice({longer}, 1, size({shorter})), {shorter}, " \
             f"(x, y) -> x <> y), true), 0), size({longer}))"
        return f"slice({longer}, cast({at} as int) + 1, size({longer})) = slice({shorter}, cast({at} as int), size({longer}))"
    differ = f"array_position(zip_with({a}, {b}, (x, y) -> x <> y), true)"
    same = f"slice({a}, cast(greatest({differ}, 1) as int) + 1, size({a})) = " \
           f"slice({b}, cast(greatest({differ}, 1) as int) + 1, size({b}))"
    return F.expr(f"case when size({a}) = size({b}) then {same} "
                  f"when size({a}) = size({b}) + 1 then {gap(a, b)} "
                  f"when size({a}) + 1 = size({b}) then {gap(b, a)} else false end")


def near_links(lines: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within one word edit."""
    long = lines.filter(F.col("n") >= MIN_WORDS)
    marks = write_table(repeated_keys(long.select(F.explode("halves").alias("key"))), "line-halves")
    sized = [f"halves[{k}]" for k in range(4)]
    found = with_mark(long, sized, marks).filter("marked").select("h1", "h2", "place", "n", words(F.col("line")).alias("w"))
    found = write_table(found, "lines-found")
    keys = variants(found)
    marks = write_table(repeated_keys(keys.select("key")), "line-variants")
    keys = with_mark(keys, ["key"], marks).filter("marked").drop("marked")
    members = write_table(keys.join(found.select("h1", "h2", "place"), ["h1", "h2"]), "line-members")
    at = F.struct("place", "h1", "h2")
    first = members.groupBy("key").agg(
        F.min(F.when(F.col("kind") == "same", at)).alias("same"),
        F.min(F.when(F.col("kind") == "less", at)).alias("less"),
        F.min(F.when(F.col("kind") == "full", at)).alias("full")).select(F.expr("key + 0L").alias("k"), "same", "less", "full")
    other = F.expr("case kind when 'same' then same when 'less' then full else less end")
    links = members.join(first, members["key"] == first["k"]).select("h1", "h2", "place", other.alias("o")).filter(
        "o.place < place").select("h1", "h2", F.col("o.h1").alias("o1"), F.col("o.h2").alias("o2")).distinct()
    texts = found.select("h1", "h2", "w")
    pairs = links.join(texts, ["h1", "h2"]).join(
        texts.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("w").alias("v")), ["o1", "o2"])
    return pairs.filter(_one_edit("w", "v")).select("h1", "h2").distinct()


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", chars_col: str | None = None) -> DataFrame:
    """`docs` with the text reduced to its kept lines, and two counts: `n_lines` of the old text, `n_kept`.

    Columns of `docs` called n_lines or n_kept are replaced; `chars_col`, if given, is set to the new length."""
    row = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t")).alias("doc"),
                      F.col(text_col).alias("text"))
    lines = distinct_lines(row)
    with scratch(docs.sparkSession):  # what led to the links is not needed any more
        gone = write_table(near_links(lines), "lines-gone", keep=True)
    # lines that cannot be among those gone are not shuffled to find out
    marks = write_table(bitmap(gone.select(F.col("h1").alias("key"))), "lines-gone-marks")
    lines = with_mark(lines.select("h1", "h2", "place", "line"), ["h1"], marks)
    stay = lines.filter("not marked").unionByName(lines.filter("marked").join(gone, ["h1", "h2"], "left_anti")).select(
        "place.doc", "place.no", "line")
    blank = _lines(row).filter(~_has_word(F.col("line"))).distinct()
    taken = [*docs.columns, "n_lines", "n_kept"]
    key, count, null, new, own, got = (free_name(taken, c) for c in ("_doc", "_lines", "_null", "_text", "_own", "_kept"))
    kept = stay.unionByName(blank).select(F.col("doc").alias(own), "no", "line").groupBy(own).agg(
        F.sort_array(F.collect_list(F.struct("no", "line"))).alias(got))
    others = [c for c in docs.columns if c != text_col and c.lower() not in ("n_lines", "n_kept")]
    marked = docs.select(*[F.col(f"`{c}`") for c in others],
                         F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t")).alias(key),
                         F.size(F.split(F.col(text_col), "\n")).alias(count), F.col(text_col).isNull().alias(null))
    # on the very struct the lines are grouped by (null ids inside it are equal): the gathered lines
    # are not shuffled again
    joined = marked.join(kept, F.col(key) == F.col(own), "left")
    text = F.when(~F.col(null), F.coalesce(F.array_join(F.col(f"{got}.line"), "\n"), F.lit("")))
    out = joined.withColumn(new, text)
    columns = [F.col(new).alias(c) if c == text_col else
               F.char_length(new).cast(docs.schema[c].dataType).alias(c) if c == chars_col else F.col(f"`{c}`")
               for c in docs.columns if c.lower() not in ("n_lines", "n_kept")]
    return out.select(*columns, F.when(F.col(null), 0).otherwise(F.col(count)).cast("long").alias("n_lines"),
                      F.coalesce(F.size(got), F.lit(0)).cast("long").alias("n_kept"))
