"""Column expressions built only from ``pyspark.sql.functions``.

They stay inside whole-stage codegen; none of them is a Python UDF.
"""

from ladle.functions.columns import (  # noqa: F401
    array_size_or_zero, as_text, dot, duration_minutes, first_element,
    has_image, is_ascii_digits, missing_flag, round_sim, text_length,
)
