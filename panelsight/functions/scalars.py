"""Column-expression builders for the scalar operators.

Every function takes and returns ``pyspark.sql.Column`` objects so that the
expressions stay inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelsight.schema import BANDS, EXPERIENCE_TIERS, HIGH_CUTOFF, MEDIUM_CUTOFF


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x, k: int) -> Column:
    """Rounding half away from zero on the binary value: sign(x) * floor(|x|*10^k + 0.5) / 10^k.

    Unlike ``F.round`` (half-up on the shortest decimal text) this gives the
    same double in any engine that follows IEEE arithmetic.
    """
    scale = float(10 ** k)
    return (F.signum(_c(x)) * F.floor(F.abs(_c(x)) * scale + 0.5) / scale).cast("double")


def clip(x, lo, hi) -> Column:
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


def nan_to_null(x) -> Column:
    """NaN -> NULL so that comparisons behave like the three-valued rules."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def kpi_score(goal, manager, peer, attendance, training, projects, overtime) -> Column:
    """Weighted KPI roll-up with per-term caps, clipped to [10, 100], 2 dp;
    NULL when any input is NULL."""
    goal, manager, peer = _c(goal), _c(manager), _c(peer)
    attendance, training = _c(attendance), _c(training)
    projects, overtime = _c(projects), _c(overtime)
    raw = (0.30 * goal
           + 0.20 * manager * 20
           + 0.15 * peer * 20
           + 0.15 * attendance * 100
           + 0.10 * F.least(training / 30, F.lit(1.0)) * 100
           + 0.05 * F.least(projects / 6, F.lit(1.0)) * 100
           + 0.05 * (1 - overtime / 50) * 100)
    # least/greatest skip NULLs, so test the inputs: any NULL input -> NULL score
    complete = (goal.isNotNull() & manager.isNotNull() & peer.isNotNull() & attendance.isNotNull()
                & training.isNotNull() & projects.isNotNull() & overtime.isNotNull())
    return F.when(complete, rnd(clip(raw, 10.0, 100.0), 2))


def performance_band(score) -> Column:
    """Score -> Low / Medium / High."""
    s = _c(score)
    return (F.when(s >= HIGH_CUTOFF, F.lit("High"))
            .when(s >= MEDIUM_CUTOFF, F.lit("Medium"))
            .when(s.isNotNull(), F.lit("Low")))


def quarter_start(year, quarter) -> Column:
    """First day of the quarter as DATE."""
    return F.make_date(_c(year), (_c(quarter) - 1) * 3 + 1, F.lit(1))


def quarter_label(year, quarter) -> Column:
    """``2022-Q3``."""
    return F.concat(_c(year).cast("string"), F.lit("-Q"), _c(quarter).cast("string"))


def quarter_key(label) -> Column:
    """P5: ``2022-Q3`` -> 20223 (sortable int). A malformed label fails the query; NULL stays NULL."""
    lab = _c(label)
    key = F.concat(F.substring(lab, 1, 4), F.substring(lab, 7, 1))
    bad = F.raise_error(F.concat(F.lit("malformed quarter label: "), lab))
    return F.when(lab.isNull(), F.lit(None)).when(lab.rlike(r"^[0-9]{4}-Q[1-4]$"), key).otherwise(bad).cast("int")


def employee_code(num) -> Column:
    """``EMP`` + id zero-padded to at least 4 digits (never truncates)."""
    s = _c(num).cast("string")
    return F.concat(F.lit("EMP"), F.lpad(s, F.greatest(F.lit(4), F.length(s)), F.lit("0")))


def tenure_offset_date(base_date: str, k) -> Column:
    """Base date minus 30*k days."""
    return F.date_sub(F.lit(base_date).cast("date"), (_c(k) * 30).cast("int"))


def experience_tier(years) -> Column:
    """(-1,3] Junior, (3,8] Mid, (8,100] Senior; outside -> NULL."""
    y = _c(years)
    expr = None
    for label, lo, hi in EXPERIENCE_TIERS:
        cond = (y > lo) & (y <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def encode_target(band) -> Column:
    """P10: Low/Medium/High -> 0/1/2; anything else -> NULL."""
    b = _c(band)
    expr = None
    for i, name in enumerate(BANDS):
        expr = F.when(b == name, F.lit(i)) if expr is None else expr.when(b == name, F.lit(i))
    return expr


def decode_band(label) -> Column:
    """0/1/2 -> band name."""
    return F.element_at(F.array(*[F.lit(b) for b in BANDS]), _c(label).cast("int") + 1)


def confidence_pct(probs) -> Column:
    """Max class probability x 100, 1 dp half-even (probs is ARRAY<DOUBLE>)."""
    return F.bround(F.array_max(_c(probs)) * 100, 1)


def argmax_class(probs) -> Column:
    """Index of the highest probability; the first wins ties."""
    p = _c(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def num_text(x, decimals: int) -> Column:
    """Half-even number text without locale (``format`` of a rounded value)."""
    r = F.bround(_c(x).cast("double"), decimals)
    if decimals == 0:
        return r.cast("long").cast("string")
    return F.format_string(f"%.{decimals}f", r)
