"""Column-expression helpers.  Everything here returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from .dates import (  # noqa: F401
    as_date, asof_lit, datediff_days, epoch_millis_of, format_epoch_millis,
    mysql_week_plus_one, reformat_date_text, window_lower,
)
from .numeric import dec, guarded_pct, ratio_or_zero, to_plain  # noqa: F401
from .text import not_empty, row_key  # noqa: F401
