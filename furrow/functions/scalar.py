"""Column expressions: identifiers, thresholds, calendars and classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from furrow import params as P


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(code, table: dict, default=None) -> Column:
    """Value of a literal map at ``code``; ``default`` where the code is NULL or absent."""
    entries = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*entries), _col(code)), F.lit(default))


def cases(*rules, otherwise=None) -> Column:
    """First matching ``(condition, value)``; values may be literals or columns."""
    expr = F.when(rules[0][0], rules[0][1])
    for cond, value in rules[1:]:
        expr = expr.when(cond, value)
    return expr.otherwise(otherwise)


# --- identifiers -------------------------------------------------------------------------

def zfill(c, width: int) -> Column:
    """Left-pad with zeros; unlike ``lpad`` a longer text is left whole."""
    c = _col(c).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def norm_station_id(c) -> Column:
    """Six-digit station number; grid point ids (``DD_lat_lon``) stay as they are."""
    c = F.trim(_col(c).cast("string"))
    return F.when(c.startswith("DD_"), c).otherwise(zfill(c, 6))


def norm_region_code(c) -> Column:
    """Integer text of a code given as int, float text or text; '' when not a number."""
    number = F.trim(_col(c).cast("string")).try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(None)).cast("bigint").cast("string"), F.lit(""))


def code9_to_5(c) -> Column:
    """State digit plus the last four digits; shorter codes are kept."""
    c = _col(c).cast("string")
    return F.when(F.length(c) >= 5, F.concat(F.substring(c, 1, 1), F.right(c, F.lit(4)))).otherwise(c)


def point_lat(c) -> Column:
    return _point_part(c, 2)


def point_lon(c) -> Column:
    return _point_part(c, 3)


def _point_part(c, i: int) -> Column:
    c = _col(c)
    part = F.try_element_at(F.split(c, "_"), F.lit(i)).try_cast("double")
    return F.when(c.startswith("DD_"), part)


# --- thresholds --------------------------------------------------------------------------

def frost_thresholds(stage) -> tuple[Column, Column, Column]:
    """(light, moderate, severe) thresholds of a stage; unlisted stages use ``emergence``."""
    fallback = P.FROST_THRESHOLDS["emergence"]
    return tuple(
        lookup(stage, {k: v[i] for k, v in P.FROST_THRESHOLDS.items()}, fallback[i]) for i in range(3)
    )


def frost_severity(temp, stage) -> Column:
    light, moderate, severe = frost_thresholds(stage)
    t = _col(temp)
    return cases((t <= severe, "severe"), (t <= moderate, "moderate"), (t <= light, "light"))


def frost_threshold_hit(temp, stage) -> Column:
    light, moderate, severe = frost_thresholds(stage)
    t = _col(temp)
    return cases((t <= severe, severe), (t <= moderate, moderate), (t <= light, light))


def heat_severity(temp, stage="grain_fill") -> Column:
    stress, severe = P.HEAT_THRESHOLDS[stage]
    t = _col(temp)
    return cases((t >= severe, "severe"), (t >= stress, "stress"))


def heat_threshold_hit(temp, stage="grain_fill") -> Column:
    stress, severe = P.HEAT_THRESHOLDS[stage]
    t = _col(temp)
    return cases((t >= severe, F.lit(severe)), (t >= stress, F.lit(stress)))


def frost_severity_flat(temp) -> Column:
    """Stage-free form with strict lower bounds."""
    t = _col(temp)
    return cases((t < -2.0, "severe"), (t < 0.0, "moderate"), (t <= 2.0, "light"))


def heat_severity_flat(temp) -> Column:
    t = _col(temp)
    return cases((t > 35.0, "very_hot"), (t > 32.0, "hot"))


def quality_confidence(code) -> Column:
    return lookup(code, P.QUALITY_CONFIDENCE, P.QUALITY_CONFIDENCE_DEFAULT)


def quality_filtered(value, quality, accept_synthetic=False, accept_interpolated=True) -> Column:
    """The value, or NULL where its quality code is not accepted."""
    q = _col(quality)
    drop = q == P.MISSING_CODE
    if not accept_synthetic:
        drop = drop | (q == P.SYNTHETIC_CODE)
    if not accept_interpolated:
        drop = drop | q.isin(*P.FILTERABLE_INTERPOLATED_CODES)
    return F.when(F.coalesce(drop, F.lit(False)), None).otherwise(_col(value))


def frost_flag(t) -> Column:
    return F.coalesce(_col(t) < 2, F.lit(False)).cast("int")


def heat_flag(t) -> Column:
    return F.coalesce(_col(t) > 32, F.lit(False)).cast("int")


def rain_flag(r) -> Column:
    return F.coalesce(_col(r) > 10, F.lit(False)).cast("int")


def clean_number(c) -> Column:
    """NaN counts as missing."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def nodata_masked(c) -> Column:
    """Grid value with sentinel and negative totals removed."""
    v = clean_number(c)
    return F.when(v >= 0, v)


def nodata_flag(c) -> Column:
    v = clean_number(c)
    return cases((v.isNull() | (v < P.NODATA_BELOW), "nodata"), (v < 0, "negative_sum"), otherwise="ok")


# --- calendar ----------------------------------------------------------------------------

def season_year(d) -> Column:
    d = _col(d)
    return F.year(d) - (F.month(d) < 5).cast("int")


def season_day(d, month: int, day: int) -> Column:
    return F.make_date(season_year(d), F.lit(month), F.lit(day))


def date_stage(d) -> Column:
    """Growth stage from the season's dates, boundary days included as in the calendar."""
    d = _col(d)
    return cases(
        (d < season_day(d, 5, 1), "pre_season"),
        (d <= season_day(d, 7, 31), "planting"),
        (d <= season_day(d, 9, 1), "vegetative"),
        (d <= season_day(d, 10, 31), "flowering"),
        (d <= season_day(d, 11, 1), "grain_filling"),
        (d <= season_day(d, 12, 31), "harvest"),
        otherwise="post_harvest",
    )


def month_stage(d) -> Column:
    """First stage, in calendar order, whose months hold the date."""
    m = F.month(_col(d))
    return cases(*[(m.isin(*months), name) for name, months, *_ in P.STAGES])


def crop_stage(d, calendar: str = "dates") -> Column:
    if calendar == "months":
        return month_stage(d)
    return lookup(date_stage(d), P.STAGE_MAP)


def stage_flag(stage, kind: str) -> Column:
    """Whether a stage is critical for ``frost``, ``heat`` or ``rain``."""
    i = {"frost": 2, "heat": 3, "rain": 4}[kind]
    return lookup(stage, {s[0]: s[i] for s in P.STAGES}, False)


def flowering_active(d) -> Column:
    d = _col(d)
    return d.between(season_day(d, 9, 1), season_day(d, 10, 31))


def days_since_flowering(d) -> Column:
    d = _col(d)
    start = season_day(d, 9, 1)
    return F.when(d >= start, F.datediff(d, start))


def days_until_harvest(d) -> Column:
    d = _col(d)
    start = season_day(d, 11, 1)
    return F.when(d < start, F.datediff(start, d)).otherwise(0)


def phenology_multiplier(stage, kind: str, in_flowering=None, since_flowering=None) -> Column:
    base = lookup(stage, P.PHENOLOGY_MULTIPLIERS[kind], 1.0)
    if kind == "frost" and in_flowering is not None:
        active = F.coalesce(_col(in_flowering), F.lit(False))
        early = active & F.coalesce(_col(since_flowering) <= P.EARLY_FLOWERING_DAYS, F.lit(False))
        base = base * F.when(active, P.FLOWERING_FACTOR).otherwise(1.0)
        base = base * F.when(early, P.EARLY_FLOWERING_FACTOR).otherwise(1.0)
    lo, hi = P.MULTIPLIER_RANGE
    return F.greatest(F.lit(lo), F.least(base, F.lit(hi)))


def risk_score(event_type, severity, confidence) -> Column:
    """Base score of (type, severity) times confidence, at most 100."""
    et, sev = _col(event_type), _col(severity)
    base = cases(
        *[(et == kind, lookup(sev, {k: v for k, v in t.items() if k}, t[None]))
          for kind, t in P.RISK_BASE.items()],
        otherwise=0.0,
    )
    return F.least(base * F.coalesce(_col(confidence), F.lit(1.0)), F.lit(100.0))


# --- classes -----------------------------------------------------------------------------

def decile_label(d) -> Column:
    return lookup(d, P.DECILE_LABELS)


def band3(d) -> Column:
    d = _col(d)
    return cases((d <= 3, "Dry (D1-D3)"), (d <= 7, "Mid (D4-D7)"), (d > 7, "Wet (D8-D10)"))


def dry_mid_wet(d) -> Column:
    d = _col(d)
    return cases((d <= 3, "dry"), (d <= 6, "mid"), (d > 6, "wet"))


def decile_tier7(pct) -> Column:
    p = _col(pct)
    return cases((p >= 100, "highest"), (p <= 0, "lowest"), (p >= 90, "d10"), (p >= 70, "d89"),
                 (p >= 30, "d47"), (p >= 10, "d23"), (p < 10, "d1"))


def pct_bin10(pct) -> Column:
    """Index 0-9 of right-closed bins of width ten."""
    p = _col(pct)
    return F.when(p.isNotNull(), F.least(F.lit(9), F.greatest(F.lit(0), F.ceil(p / 10) - 1))).cast("int")


def break_status_doy(doy) -> Column:
    d = _col(doy)
    return cases((d < P.BREAK_EARLY_DOY, "early"), (d <= P.BREAK_LATE_DOY, "on_time"),
                 (d > P.BREAK_LATE_DOY, "late"))


def break_status_date(d) -> Column:
    d = _col(d)
    y = F.year(d)
    return cases((d < F.make_date(y, F.lit(5), F.lit(15)), "early"),
                 (d <= F.make_date(y, F.lit(6), F.lit(15)), "on_time"),
                 (d.isNotNull(), "late"))


def seeding_class(mm) -> Column:
    v = _col(mm)
    return cases((v >= 25, "Adequate"), (v >= 15, "Marginal"), (v >= 10, "Marginal-low"),
                 (v < 10, "Insufficient"))


def season_class(mm) -> Column:
    v = _col(mm)
    return cases((v >= 70, "Strong"), (v >= 40, "Adequate"), (v >= 20, "Below average"), (v < 20, "Poor"))


def window_class(score) -> Column:
    s = _col(score)
    return cases((s < 4, "dry"), (s < 7, "avg"), (s >= 7, "wet"))


def dual_window_class(a, b) -> Column:
    """Quadrant of an earlier and a later window's decile scores."""
    ca, cb = window_class(a), window_class(b)
    return cases(
        (ca.isNull() | cb.isNull(), None),
        ((ca == "dry") & (cb == "dry"), "persistent_dry"),
        ((ca == "dry") & (cb == "wet"), "recovered"),
        ((ca == "wet") & (cb == "dry"), "fading"),
        ((ca == "wet") & (cb == "wet"), "solid"),
        otherwise="mixed",
    )


def feature_quality_flag(season, sowing, in_crop, in_progress, min_coverage=0.8) -> Column:
    return cases(
        (_col(season) < min_coverage, "insufficient_season"),
        (_col(sowing) < min_coverage, "insufficient_sowing_window"),
        (_col(in_crop) < min_coverage, "partial"),
        (F.coalesce(_col(in_progress), F.lit(False)), "complete_to_date"),
        otherwise="complete",
    )


def sowing_band(break_day, optimal_start, optimal_end, latest_viable, percentile) -> Column:
    """Pressure band of a break day against a sowing window; NULL when in time."""
    d = _col(break_day)
    extreme = (d > _col(latest_viable) + P.EXTREME_MARGIN_DAYS) & F.coalesce(
        _col(percentile) >= P.EXTREME_PERCENTILE, F.lit(False))
    return cases(
        (d <= _col(optimal_start), None),
        (d <= _col(optimal_end), "low"),
        (d <= _col(latest_viable), "medium"),
        (extreme, "extreme"),
        (d.isNotNull(), "high"),
    )


def season_label(year) -> Column:
    y = _col(year)
    return F.concat(y.cast("string"), F.lit("/"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def doy_to_date(doy, year) -> Column:
    return F.date_add(F.make_date(_col(year), F.lit(1), F.lit(1)), _col(doy).cast("int") - 1)


def parse_date_mixed(c, formats=("yyyy-MM-dd", "yyyyMMdd", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss")) -> Column:
    """First format that reads the text as a date; NULL when none does."""
    c = _col(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats])


def pct_of_median(value, median, floor: float | None = None) -> Column:
    """100 x value / median; a zero median gives NULL unless a floor is set."""
    m = _col(median)
    m = F.greatest(m, F.lit(floor)) if floor is not None else F.nullif(m, F.lit(0.0))
    return _col(value) / m * 100.0


def days_in_month(year, month) -> Column:
    return F.day(F.last_day(F.make_date(_col(year), _col(month), F.lit(1))))


def days_in_year(year) -> Column:
    return F.dayofyear(F.make_date(_col(year), F.lit(12), F.lit(31)))


def all_of(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


def planar_distance(lat1, lon1, lat2, lon2) -> Column:
    return F.sqrt(F.pow(_col(lat1) - _col(lat2), 2) + F.pow(_col(lon1) - _col(lon2), 2))
