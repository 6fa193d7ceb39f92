"""Audit of report texts against the metadata block they carry and the current inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow import params as P

_FENCE = "```vintage"
_BLOCK = r"(?s)```vintage[ \t]*\n(.*?)\n```"
_ENTRIES = "array<struct<k:string,v:string>>"


def _plain(value: Column) -> Column:
    """A value without white space around it and without its quotes."""
    return F.regexp_replace(F.trim(value), r"""^(["'])(.*)\1$""", "$2")


def _entries(block: Column) -> Column:
    """(key, value) pairs of a block in order, folded over its lines.

    A line is ``key: value``, ``key: [a, b]``, ``key:`` with ``- item`` lines below, or a comment; a value may be quoted. A key
    without any value has no pair.
    """
    none = F.array().cast(_ENTRIES)
    bare = F.transform(F.split(block, "\n"), lambda line: F.rtrim(F.regexp_replace(line, r"(^|[ \t])#.*$", "")))
    start = F.struct(F.lit(None).cast("string").alias("key"), none.alias("found"))

    def pair(key, value):
        return F.struct(key.alias("k"), _plain(value).alias("v"))

    def fold(acc, line):
        key = F.nullif(F.regexp_extract(line, r"^([A-Za-z_]\w*):", 1), F.lit(""))
        value = F.trim(F.regexp_extract(line, r"^[A-Za-z_]\w*:(.*)$", 1))
        inner = F.filter(F.split(F.regexp_extract(value, r"^\[(.*)\]$", 1), ","), lambda v: F.trim(v) != "")
        item = F.regexp_extract(line, r"^[ \t]*-[ \t]+(.*)$", 1)
        own = F.when(value.rlike(r"^\[.*\]$"), F.transform(inner, lambda v: pair(key, v))).when(value != "", F.array(pair(key, value))).otherwise(none)
        below = F.when(acc["key"].isNotNull() & (item != ""), F.array(pair(acc["key"], item))).otherwise(none)
        return F.struct(F.coalesce(key, acc["key"]).alias("key"), F.concat(acc["found"], F.when(key.isNotNull(), own).otherwise(below)).alias("found"))

    return F.aggregate(bare, start, fold, lambda acc: acc["found"])


def _values(name: str) -> Column:
    return F.transform(F.filter("entries", lambda e: e["k"] == name), lambda e: e["v"])


def parse_blocks(reports: DataFrame, text: str = "markdown") -> DataFrame:
    """Metadata fields of each report, and its prose without the block.

    ``inputs`` is an array, NULL when the block names none; ``baseline_years`` is written ``[first, last]`` in either list form.
    """
    fenced = F.contains(text, F.lit(_FENCE))
    out = reports.withColumns({
        "entries": F.when(fenced, _entries(F.regexp_extract(text, _BLOCK, 1))),
        "has_block": F.when(fenced, F.col(text).rlike(_BLOCK)).otherwise(False),
        "prose": F.when(fenced, F.regexp_replace(text, _BLOCK, "")).otherwise(F.col(text)),
    })
    single = [f for f in (*P.VINTAGE_REQUIRED, "decile_method") if f != "baseline_years"]
    years = _values("baseline_years")
    out = out.withColumns({
        **{f: F.nullif(F.get(_values(f), F.lit(0)), F.lit("")) for f in single},
        "baseline_years": F.when(F.size(years) > 0, F.concat(F.lit("["), F.array_join(years, ", "), F.lit("]"))),
        "inputs": F.when(F.size(_values("inputs")) > 0, _values("inputs"))})
    return out.withColumn("through_day", F.col("through_day").try_cast("int")).drop("entries", text)


def coverage_days(prose: str = "prose", month: str = "coverage_month") -> Column:
    """All coverage-day claims in the prose about its coverage month (``yyyy-MM``), as sorted distinct integers.

    A claim names a day after "through day", "<month> 1-" or "Data through <month>-", or counts "n of <days> days"; the wording
    follows the month of each report. A plain search for a word of every claim spares most texts the patterns.
    """
    first = F.try_to_timestamp(F.concat(month, F.lit("-01")), F.lit("yyyy-MM-dd")).cast("date")
    name = F.get(F.array(*[F.lit(m) for m in P.MONTH_NAMES]), F.month(first) - 1)
    never, none = F.lit("(?!)"), F.array().cast("array<string>")
    after = F.concat(F.lit("(?:through day |"), F.coalesce(name, never), F.lit(" 1[–-]|(?:Data|Coverage) through "),
                     F.coalesce(F.date_format(first, "yyyy-MM"), never), F.lit("-)([0-9]{1,2})\\b"))
    count = F.concat(F.lit("\\b([0-9]{1,2}) of "), F.coalesce(F.day(F.last_day(first)).cast("string"), never), F.lit(" days\\b"))
    begins = F.contains(prose, F.lit("through ")) | F.coalesce(F.contains(prose, F.concat(name, F.lit(" 1"))), F.lit(False))
    found = F.concat(F.when(begins, F.regexp_extract_all(prose, after, F.lit(1))).otherwise(none),
                     F.when(F.contains(prose, F.lit(" days")), F.regexp_extract_all(prose, count, F.lit(1))).otherwise(none))
    return F.array_sort(F.array_distinct(F.transform(found, lambda d: d.cast("int"))))


def current_through_days(history: DataFrame, label: str) -> DataFrame:
    """Largest partial-month day per coverage month of one input table."""
    month = F.format_string("%04d-%02d", F.col("year"), F.col("month"))
    return history.groupBy(month.alias("coverage_month")).agg(
        F.max("partial_month_through_day").alias("current_through_day")).withColumn("input", F.lit(label))


def audit(reports: DataFrame, current: DataFrame, baseline_years: str = "[2005, 2025]", report_id: str = "report_id") -> DataFrame:
    """One row per finding. A malformed block ends the checks of its report.

    ``current`` has input, coverage_month and current_through_day. Whole texts are scanned where
    they lie; only the short fields are exploded and joined.
    """
    r = parse_blocks(reports).withColumn("claims", coverage_days())
    schema = [F.when(F.col(f).isNull(), f"missing required field '{f}'") for f in P.VINTAGE_REQUIRED]
    schema += [
        F.when(~F.col("status").isin(*P.VINTAGE_STATUSES), F.concat(F.lit("bad status "), F.col("status"))),
        F.when(~F.col("decile_method").isin(*P.VINTAGE_METHODS), F.concat(F.lit("unknown decile_method "), F.col("decile_method"))),
        F.when((F.col("status") == "live") & F.col("inputs").isNull(), "live report must list 'inputs'"),
    ]
    wrong_days = F.transform(
        F.filter("claims", lambda d: d != F.col("through_day")),
        lambda d: F.concat(F.lit("prose coverage-day "), d.cast("string"), F.lit(" does not match through_day "),
                           F.col("through_day").cast("string")))
    forbidden = [
        F.when((F.col("decile_method") == m) & F.contains("prose", F.lit(t)), f"prose contains '{t}'")
        for m, tokens in P.VINTAGE_METHODS.items() for t in tokens]
    live = F.col("status") == "live"
    stale = [
        F.when(live & (F.col("decile_method") != P.VINTAGE_CURRENT_METHOD), "live decile_method differs from current"),
        F.when(live & (F.col("baseline_years") != baseline_years), "live baseline_years differ from current"),
    ]
    none = F.array().cast("array<string>")
    r = r.withColumns({"_schema": F.array_compact(F.array(*schema)),
                       "_rest": F.concat(wrong_days, F.array_compact(F.array(*forbidden, *stale)))})
    findings = F.when(~F.col("has_block"), F.array(F.lit("missing vintage block"))).when(
        F.size("_schema") > 0, F.col("_schema")).otherwise(F.coalesce("_rest", none))
    checked = F.col("has_block") & (F.size("_schema") == 0) & live
    inputs = F.when(checked, F.col("inputs")).otherwise(none)
    # static findings and inputs to look up leave the text scan together, so texts are read once
    rows = F.concat(
        F.transform(findings, lambda f: F.struct(f.alias("finding"), F.lit(None).cast("string").alias("input"))),
        F.transform(inputs, lambda i: F.struct(F.lit(None).cast("string").alias("finding"), i.alias("input"))))
    slim = r.select(report_id, "coverage_month", "through_day", F.explode(rows).alias("f")).select(
        report_id, "coverage_month", "through_day", "f.finding", "f.input")
    now = slim.join(current, ["input", "coverage_month"], "left")
    drift = F.when(F.col("input").isNotNull() & F.col("current_through_day").isNull(), F.concat(F.lit("cannot determine current through_day in "), F.col("input"))).when(
        F.col("current_through_day") != F.col("through_day"),
        F.concat(F.lit("live through_day "), F.col("through_day").cast("string"), F.lit(" differs from current "),
                 F.col("current_through_day").cast("string"), F.lit(" in "), F.col("input")))
    return now.select(report_id, F.coalesce("finding", drift).alias("finding")).where(F.col("finding").isNotNull())
