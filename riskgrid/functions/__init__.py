"""Column-expression helpers; all built on ``pyspark.sql.functions`` (JVM-side)."""

from riskgrid.functions.columns import (  # noqa: F401
    FIXED_SCALE, fixed_point, from_fixed, nan_to_null,
)
from riskgrid.functions.geo import (  # noqa: F401
    in_box, nearest_segment_degrees, point_segment_degrees,
)
