from .dates import (business_date, partition_calendar, reference_date, strict_date,
                    strict_date_text)
from .numbers import (denominator_status, numeric_warning, ratio_percent, safe_divide,
                      to_metric_decimal)
from .text import ERROR_CATEGORIES, clean_error, format_error

__all__ = [
    "ERROR_CATEGORIES", "business_date", "clean_error", "denominator_status", "format_error",
    "numeric_warning", "partition_calendar", "ratio_percent", "reference_date", "safe_divide",
    "strict_date", "strict_date_text", "to_metric_decimal",
]
