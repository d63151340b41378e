"""Scalar column expressions (all JVM-side, codegen-friendly)."""

from panelsight.functions.scalars import (  # noqa: F401
    rnd, clip, nan_to_null, kpi_score, performance_band, quarter_start,
    quarter_label, quarter_key, employee_code, tenure_offset_date,
    experience_tier, encode_target, decode_band, confidence_pct,
    argmax_class, num_text,
)
