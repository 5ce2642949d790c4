"""Lines that recur across documents up to variable fields, by a log-template tree.

The tree has a fixed depth: a line goes by its number of tokens and then by its leading
tokens to a leaf. A token that more than half of a leaf's different lines have at a place is
constant there, any other place is a variable field; these make the leaf's template, which
all lines belong to that have enough of its constants. The others go on to children of the leaf,
by their token at the place where they differ least, and so on for a fixed number of
levels. Shares decide, not numbers, so a template is found alike among few lines and many.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import bucket, maybe_in, stored

#: Leading tokens on the way to a leaf, and levels of templates from there on.
DEPTH, LEVELS = 3, 3
#: Different texts that a template with variable fields must recur in; the same line, two.
MIN_DOCS = 5
#: Least number of tokens of a line, and the share of them that must be the template's constants.
MIN_TOKENS = 4
MIN_CONSTANT = 0.6

VARIABLE = "<*>"
_KEY = ["_k1", "_k2"]

# Parts that the texts of one line are dealt in.
_SALTS = 16


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _tokens(line: Column) -> Column:
    odd = reduce(or_, [F.contains(line, F.lit(c)) for c in "\t\n\x0b\x0c\r"])
    plain = F.when(odd, F.translate(line, "\t\n\x0b\x0c\r", "     ")).otherwise(line)
    return F.filter(F.split(plain, " "), lambda t: t != "")


def _masked(token: Column) -> Column:
    """A token with a digit is a variable field from the start."""
    return F.when(token.rlike("[0-9]"), VARIABLE).otherwise(token)


def _leaf(tokens: Column, depth: int) -> Column:
    lead = F.transform(F.slice(tokens, 1, depth), _masked)
    return F.xxhash64(F.size(tokens), lead)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Documents with a key of their text: rows with the same text get the same lines."""
    filled = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"_k1": F.xxhash64(filled), "_k2": F.crc32(filled.cast("binary"))})


def _line_key(line: Column) -> Column:
    return F.xxhash64(line, F.octet_length(line))


def _marked(df: DataFrame, keys: DataFrame, col: str, name: str) -> DataFrame:
    """``df`` with ``name``: true if the row's key may be among ``keys``, else null or false."""
    buckets = keys.select(bucket(col).alias("_bucket"), F.lit(True).alias(name)).distinct()
    return df.withColumn("_bucket", bucket(col)).join(F.broadcast(buckets), "_bucket", "left").drop("_bucket")


def _level(lines: DataFrame, level: int, min_constant: float) -> tuple[DataFrame, DataFrame]:
    """One level of templates over ``lines`` (_line, _group, _tokens): who fits, and the rest.

    Counts are summed per group, place and token before they are shuffled; the join has one
    template per group on its other side.
    """
    counts = (
        lines.select("_group", F.posexplode("_tokens").alias("_pos", "_token"))
        .groupBy("_group", "_pos", "_token")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    places = counts.groupBy("_group", "_pos").agg(
        F.max(F.struct("_n", "_token")).alias("_most"),
        F.sum("_n").alias("_all"),
        F.count(F.lit(1)).alias("_kinds"),
    )
    most = F.col("_most._token")
    constant = (2 * F.col("_most._n") > F.col("_all")) & (most != VARIABLE)
    templates = places.groupBy("_group").agg(
        F.sort_array(F.collect_list(F.struct("_pos", F.when(constant, most).alias("t")))).alias("_template"),
        F.min(F.when(F.col("_kinds") > 1, F.struct("_kinds", "_pos"))).alias("_least"),
    )
    same = F.zip_with("_tokens", F.col("_template.t"), lambda a, b: F.coalesce(a == b, F.lit(False)))
    enough = F.size(F.filter(same, lambda x: x)) >= min_constant * F.size("_tokens")
    met = stored(
        lines.join(templates, "_group").select(
            "_line", "_group", "_tokens", enough.alias("_fits"),
            F.get("_tokens", F.col("_least._pos")).alias("_next"),
        ),
        "levels",
    )
    fits = met.where("_fits").select("_line", F.xxhash64("_group", F.lit(level)).alias("_template"))
    rest = met.where("NOT _fits").select("_line", "_tokens", F.xxhash64("_group", "_next").alias("_group"))
    return fits, rest


def recurring_lines(
    docs: DataFrame,
    text: str = "text",
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    min_tokens: int = MIN_TOKENS,
    min_constant: float = MIN_CONSTANT,
) -> DataFrame:
    """``(_k1, _k2, _line)``: for each text key, the keys of its lines to drop.

    A line recurs if it stands in two different texts, or if lines of its template stand in
    ``min_docs`` different ones. Whole documents that repeat count as one text, so copies alone
    make no line recur. Lines are counted as rows of a few numbers; only those whose leaf has
    enough others are looked at token by token, each once however often it stands.
    """
    keyed = _keyed(docs.select(F.col(text).alias("_text")), "_text")
    rows = keyed.select(*_KEY, F.explode(F.array_distinct(_lines("_text"))).alias("_text")).withColumn(
        "_line", _line_key(F.col("_text"))
    )

    def parted(rows: DataFrame) -> DataFrame:
        found = rows.withColumn("_tokens", _tokens(F.col("_text"))).where(F.size("_tokens") >= min_tokens)
        return found.withColumn("_leaf", _leaf(F.col("_tokens"), depth))

    seen = stored(
        parted(rows).groupBy("_leaf", "_line").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_k1").alias("_low"), F.max("_k1").alias("_high")
        ),
        "lines-seen",
    )
    same = stored(seen.where("_low != _high").select("_line"), "same-lines")
    # A line of one text counts once, however often the text is there.
    texts = F.when(F.col("_low") == F.col("_high"), 1).otherwise(F.col("_n"))
    leaves = stored(
        seen.groupBy("_leaf")
        .agg(F.sum(texts).alias("_n"), F.count(F.lit(1)).alias("_lines"))
        .where((F.col("_n") >= min_docs) & (F.col("_lines") > 1))
        .select("_leaf"),
        "alike-leaves",
    )
    alike = stored(seen.join(leaves, "_leaf", "left_semi").select("_line"), "alike-lines")
    found = _marked(_marked(rows, alike, "_line", "_alike"), same, "_line", "_same")
    # Buckets of lines fill up as lines grow; there are fewer leaves, and the rest is told exactly.
    found = _marked(parted(found.where("_alike OR _same")), leaves, "_leaf", "_wanted")
    wanted = F.col("_alike") & F.col("_wanted")
    found = stored(
        found.where(wanted | F.col("_same")).select(
            *_KEY, "_leaf", "_line", F.when(wanted, F.transform("_tokens", _masked)).alias("_tokens")
        ),
        "lines",
    )
    lines = stored(
        found.where("_tokens IS NOT NULL")
        .groupBy("_line", F.col("_leaf").alias("_group"))
        .agg(F.first("_tokens").alias("_tokens"))
        .join(leaves.withColumnRenamed("_leaf", "_group"), "_group", "left_semi")
        .select("_line", "_group", "_tokens"),
        "different-lines",
    )
    placed = []
    for level in range(LEVELS):
        fits, lines = _level(lines, level, min_constant)
        placed.append(fits)
    templates = stored(reduce(DataFrame.unionAll, placed), "templates")
    recurring = (
        found.select(*_KEY, "_line").join(templates, "_line").select("_template", *_KEY).distinct()
        .groupBy("_template").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= min_docs)
    )
    general = templates.join(recurring, "_template", "left_semi").select("_line")
    # One row per line to drop; the texts of a line that is everywhere meet it in several parts.
    gone = general.unionAll(same).distinct().withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    )
    dealt = found.select(*_KEY, "_line", F.pmod("_k1", F.lit(_SALTS)).cast("int").alias("_salt"))
    return dealt.join(gone, ["_line", "_salt"], "left_semi").select(*_KEY, "_line").distinct()


def drop_recurring_lines(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``text`` without its recurring lines, and ``n_lines``, ``n_dropped``.

    Other lines stay as they are and in their order; blank lines and lines of fewer than
    MIN_TOKENS tokens always stay. A line that two different texts have goes, and so does one
    whose template recurs (see ``recurring_lines``). A null text counts as empty: one line,
    none dropped.
    Rows that repeat a text, and documents with equal ids, are treated alike. An empty
    table gives an empty result; other columns are carried along under any name.
    """
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    own = f"c{columns.index(text)}"
    keyed = _keyed(plain, own)
    drops = stored(recurring_lines(plain, own, **options), "drops")
    untouched = maybe_in(keyed, drops, _KEY, keep=False).withColumns(
        {
            own: F.coalesce(F.col(own), F.lit("")),
            "_lines": F.size(_lines(own)).cast("long"),
            "_dropped": F.lit(0).cast("long"),
        }
    )
    # One row per text: at most one key per distinct line of it.
    per_text = drops.groupBy(*_KEY).agg(F.collect_set("_line").alias("_drop"))
    kept = F.filter(
        _lines(own),
        lambda line: ~F.coalesce(F.array_contains("_drop", _line_key(line)), F.lit(False)),
    )
    touched = (
        maybe_in(keyed, drops, _KEY)
        .join(per_text, _KEY, "left")
        .withColumn("_kept", kept)
        .withColumns(
            {
                "_lines": F.size(_lines(own)).cast("long"),
                "_dropped": (F.size(_lines(own)) - F.size("_kept")).cast("long"),
                own: F.concat_ws("\n", "_kept"),
            }
        )
    )
    chosen = [*plain.columns, "_lines", "_dropped"]
    return (
        untouched.select(*chosen).unionByName(touched.select(*chosen))
        .toDF(*columns, "n_lines", "n_dropped")
    )
