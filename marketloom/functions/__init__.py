from marketloom.functions.scalar import (  # noqa: F401
    day,
    is_missing,
    leading_number,
    missing_to_null,
    non_zero,
    pct_change,
    ratio,
    round_half_away,
    same_text,
    year_before,
)
