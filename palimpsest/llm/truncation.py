"""Text cut off by field limits or in transfer: detection and rates per source.

Per source and column, lengths in characters and in bytes form histograms of the *open* values, those that do not end like a finished
text.  A spike at the maximum - far more open values at one length than at the lengths before it, and hardly any beyond - is a field
limit; open values at a spike are cut.  A byte limit leaves up to three bytes unused where a character did not fit.

Cuts in transfer leave no spike but broken structure: an opened link, bracket or section mark, half an entity, half a character.
Every source is examined further: an open value whose last word (a name or number: masked, with the word before it) never, or far more
rarely, ends a value of the other sources with the fewest broken values is cut, too, unless such endings are as many there by chance.
Titles can also be compared with the titles that exist: an unknown title that an existing one continues in the middle of a word is the
front part of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.common import salted_lookup
from palimpsest.scratch import Scratch

#: How a finished value ends, optional blanks aside: a mark of sentence end, an ellipsis, a closing bracket or quote.
TERMINAL = r"[.!?…。！？)\]}\"'»”’>:*/]\s*$"
#: Structure that a cut leaves broken at the end of a value.
BROKEN = (
    r"�\s*$"  # half a character
    r"|\[\[[^\]]*\]?$"  # an opened link
    r"|\{\{[^}]*\}?$"  # an opened template
    r"|\([^()]*$"  # an opened bracket
    r"|/\*(?:(?!\*/).)*$"  # an opened section mark
    r"|&#?[A-Za-z0-9]{0,8}$"  # half an entity
)


def is_open(value: Column) -> Column:
    """Whether a value ends like an unfinished text; null and empty values do not."""
    return F.coalesce((F.length(value) > 0) & ~value.rlike(TERMINAL), F.lit(False))


def is_broken(value: Column) -> Column:
    return F.coalesce(value.rlike(BROKEN), F.lit(False))


def measured(values: DataFrame, value: str) -> DataFrame:
    """``values`` with what the tests need of a value: its lengths, whether it is open, whether it is broken, and how it ends."""
    v = F.col(value)
    opened = values.withColumns({"__chars": F.length(v), "__bytes": F.octet_length(v), "__open": is_open(v)})
    half = v.rlike(r"�\s*$")
    broken = F.when(F.col("__open") | half, is_broken(v)).otherwise(F.lit(False))
    return opened.withColumns({"__broken": broken, "__half": half, "__end": F.when(F.col("__open"), _ending(v))})


def length_limits(
    values: DataFrame, group: list[str], *, window: int = 24, least: int = 3, ratio: float = 5.0, beyond: float = 0.05
) -> DataFrame:
    """(*group, unit, limit) of the groups whose lengths have a spike at the maximum; ``unit`` is 'chars' or 'bytes'.

    A spike holds at least ``least`` open values, more than ``ratio`` times and more than three Poisson deviations above the mean of
    the ``window`` lengths before it, and at most ``beyond`` times as many values are longer.  Where both units qualify, the
    characters decide unless the byte length is bounded while the characters are not at one length.  ``values`` are ``measured``.
    """
    both = values.where("__chars > 0").groupBy(*group, "__chars", "__bytes").agg(
        F.count_if("__open").alias("open"), F.count(F.lit(1)).alias("all")
    )
    units = F.explode(
        F.array(
            F.struct(F.lit("chars").alias("unit"), F.col("__chars").alias("len")),
            F.struct(F.lit("bytes").alias("unit"), F.col("__bytes").alias("len")),
        )
    ).alias("u")
    lengths = both.select(*group, "open", "all", units).groupBy(*group, F.col("u.unit").alias("unit"), F.col("u.len").alias("len")).agg(
        F.sum("open").alias("open"), F.sum("all").alias("all")
    )
    by = Window.partitionBy(*group, "unit").orderBy("len")
    lengths = lengths.withColumn("near", F.coalesce(F.sum("open").over(by.rangeBetween(-window, -1)), F.lit(0)) / F.lit(float(window)))
    lengths = lengths.withColumn("longer", F.coalesce(F.sum("all").over(by.rangeBetween(1, Window.unboundedFollowing)), F.lit(0)))
    spike = (
        (F.col("open") >= least)
        & (F.col("open") > ratio * F.col("near"))
        & (F.col("open") > F.col("near") + 3 * F.sqrt(F.col("near")))
        & (F.col("longer") <= beyond * F.col("open"))
    )
    found = lengths.where(spike).groupBy(*group, "unit").agg(F.max(F.struct("open", "len")).alias("top"))
    best = Window.partitionBy(*group).orderBy(F.col("top.open").desc(), F.col("unit").desc())
    return found.withColumn("r", F.row_number().over(best)).where("r = 1").select(*group, "unit", F.col("top.len").alias("limit"))


def _ending(value: Column) -> Column:
    """The last word in lower case.  A word with a capital or a digit is masked and counts with the word before it."""
    words = F.filter(F.split(F.substring_index(F.regexp_replace(value, r"\s+$", ""), " ", -3), r"\s+"), lambda w: w != "")
    masked = F.transform(
        words, lambda w: F.when(w.rlike(r"\p{Lu}"), F.lit("N")).when(w.rlike(r"\d"), F.lit("0")).otherwise(w)
    )
    last, before = F.try_element_at(masked, F.lit(-1)), F.coalesce(F.try_element_at(masked, F.lit(-2)), F.lit("^"))
    return F.when(last.isin("N", "0"), F.concat_ws(" ", before, last)).otherwise(last)


def truncated_values(values: DataFrame, *, source: str = "source", column: str = "column", value: str = "value") -> DataFrame:
    """``values`` with ``cut``: 'limit', 'transfer' or null.

    One row per value; null and empty values are never cut.  A null source counts as a source of its own.  Limits and rates are
    computed over all rows per (source, column), and once more per column over all sources, for sources with few values.
    """
    scratch = Scratch(values.sparkSession, "truncation")
    rows = scratch.write(measured(values.withColumn("__src", F.coalesce(F.col(source), F.lit(""))), value), "measured")
    own = length_limits(rows, ["__src", column]).select("__src", column, F.col("unit").alias("__unit"), F.col("limit").alias("__limit"))
    pooled = length_limits(rows, [column]).select(
        column, F.col("unit").alias("__p_unit"), F.col("limit").alias("__p_limit")
    )
    limits = scratch.write(own, "limits")  # one row per source and column
    pooled = scratch.write(pooled, "pooled")  # one row per column
    joined = rows.join(F.broadcast(pooled), column, "left")
    joined = salted_lookup(joined, limits, ["__src", column])
    at = lambda unit, limit: F.when(
        F.col(unit) == "bytes", F.col("__bytes").between(F.col(limit) - 3, F.col(limit))
    ).otherwise(F.col("__chars") == F.col(limit))
    limit_hit = F.coalesce(at("__unit", "__limit"), F.lit(False)) | F.coalesce(at("__p_unit", "__p_limit"), F.lit(False))
    marked = joined.withColumn("__at_limit", limit_hit).drop("__unit", "__limit", "__p_unit", "__p_limit")

    below = F.col("__open") & ~F.col("__at_limit")
    rates = marked.groupBy("__src", column).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__broken") & ~F.col("__at_limit")).alias("broken")
    )
    usual = Window.partitionBy(column)
    rates = rates.withColumn("rate", F.col("broken") / F.col("n")).withColumn("usual", F.median("rate").over(usual))
    rates = rates.withColumn("cutting", (F.col("rate") > 0.002) & (F.col("rate") > 5 * F.col("usual")) & (F.col("broken") >= 3))
    rates = rates.withColumn("plain", F.col("rate") <= F.col("usual"))
    rates = scratch.write(rates.select("__src", column, "n", "cutting", "plain"), "rates")
    odd = scratch.write(_odd_endings(marked.where(below & ~F.col("__broken")), rates, column, scratch), "odd")
    out = salted_lookup(marked, odd, ["__src", column, "__end"])
    cut = F.when(F.col("__open") & F.col("__at_limit"), F.lit("limit")).when(
        (F.col("__open") | F.col("__half")) & (F.col("__broken") | F.coalesce("__odd", F.lit(False))), F.lit("transfer")
    )
    return out.withColumn("cut", cut).drop("__src", "__chars", "__bytes", "__open", "__half", "__broken", "__at_limit", "__end", "__odd")


def _odd_endings(opened: DataFrame, rates: DataFrame, column: str, scratch: Scratch) -> DataFrame:
    """(__src, column, __end, __odd) of the endings that are cuts, tested in every source.

    An ending is rare if the plain sources, those with the fewest broken values and the source itself left out, never or far less often
    end a value so.  What plain sources show as rare among themselves is chance; a source's rare endings are cuts if they are more
    than three times as many as that chance (one row more than seen) explains, or if the source's broken values stand out.
    """
    ends = opened.groupBy(column, "__src", "__end").agg(F.count(F.lit(1)).alias("c"))
    ends = salted_lookup(ends, rates, ["__src", column], "inner")
    seen = ends.where("plain").groupBy(column, "__end").agg(F.sum("c").alias("seen"))
    rows = rates.groupBy(column).agg(F.sum(F.when(F.col("plain"), F.col("n")).otherwise(0)).alias("plain_rows"))
    own = lambda name: F.when(F.col("plain"), F.col(name)).otherwise(0)
    ends = ends.join(seen.hint("merge"), [column, "__end"], "left").join(F.broadcast(rows), column)  # one row per column
    theirs, their_rows = F.coalesce("seen", F.lit(0)) - own("c"), F.col("plain_rows") - own("n")
    rarer = (their_rows > 0) & (theirs * F.col("n") < 0.2 * F.col("c") * their_rows)
    rare = scratch.write(ends.where(rarer & ((theirs == 0) | F.col("cutting") | (F.col("c") >= 3))).select("__src", column, "__end", "c"), "rare")

    sums = rare.groupBy("__src", column).agg(F.sum("c").alias("rare"))
    sums = rates.join(sums.hint("merge"), ["__src", column], "left").fillna(0, ["rare"])
    chance = sums.groupBy(column).agg(F.sum(own("rare")).alias("plain_rare"), F.sum(own("n")).alias("plain_rows"))
    more = F.col("rare") * their_rows > 3 * F.col("n") * (F.col("plain_rare") - own("rare") + 1)
    tested = scratch.write(sums.join(F.broadcast(chance), column).where(F.col("cutting") | more).select("__src", column), "tested")
    return salted_lookup(rare, tested, ["__src", column], "inner").select("__src", column, "__end", F.lit(True).alias("__odd"))


def cut_titles(titles: DataFrame, known: DataFrame, *, title: str, name: str) -> DataFrame:
    """Distinct ``title`` values that are no known name but that a known name continues in mid-word or inside a bracket.

    Underscores count as blanks.  Each known name is compared by its prefixes, so the work is linear in the text of the names.  The
    hints keep Spark, whose size estimate sees compressed files and no prefixes, from broadcasting names or prefixes.
    """
    plain = lambda c: F.trim(F.translate(c, "_", " "))
    names = known.where(F.col(name).isNotNull()).select(plain(F.col(name)).alias("name")).distinct()
    asked = titles.where(F.length(title) > 2).select(title, F.ltrim(F.translate(F.col(title), "_", " ")).alias("asked")).distinct()
    unknown = asked.join(names.hint("merge"), asked["asked"] == names["name"], "left_anti")
    sized = names.where(F.length("name") > 3).select("name", F.explode(F.sequence(F.lit(3), F.length("name") - 1)).alias("n"))
    prefix, following = F.col("name").substr(F.lit(1), F.col("n")), F.col("name").substr(F.col("n") + 1, F.lit(1))
    mid_word = prefix.rlike(r"[\p{L}\p{N}]$") & following.rlike(r"[\p{L}\p{N}]")
    prefixes = sized.where(mid_word | prefix.rlike(r"\([^)]*$")).select(prefix.alias("asked"))
    return unknown.join(prefixes.hint("merge"), "asked", "left_semi").select(title)


def truncation_report(marked: DataFrame, source: str = "source", column: str = "column") -> DataFrame:
    """Per source and column: values, values cut at a limit and in transfer, and the share cut.  Needs ``cut``."""
    return (
        marked.groupBy(source, column)
        .agg(
            F.count(F.lit(1)).alias("values"),
            F.count_if(F.col("cut") == "limit").alias("cut_at_limit"),
            F.count_if(F.col("cut") == "transfer").alias("cut_in_transfer"),
        )
        .withColumn("cut_share", F.round((F.col("cut_at_limit") + F.col("cut_in_transfer")) / F.col("values"), 6))
    )
