"""Column-level helpers (built-in Spark expressions only) and dimensions."""

from .columns import (  # noqa: F401
    clamp01,
    format_date_dmy,
    format_price,
    normalized_name,
    pad_code,
    price_bin,
    tidy_label,
)
from .dims import (  # noqa: F401
    department_names_df,
    department_region_df,
    region_names_df,
)
