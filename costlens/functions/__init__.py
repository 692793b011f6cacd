"""Column expressions built only from ``pyspark.sql.functions``.

They stay inside whole-stage code generation; none of them is a Python UDF.
"""

from costlens.functions.labels import phase_label, strip_suffix
from costlens.functions.numeric import (
    dollars_per_edge,
    dollars_per_ns,
    is_finite,
    json_double,
    ns_per_dollar,
    safe_divide,
)
from costlens.functions.ordering import domain_order, domain_position
from costlens.functions.paths import path_group, run_date_from_path, run_id_from_path

__all__ = [
    "dollars_per_edge",
    "dollars_per_ns",
    "domain_order",
    "domain_position",
    "is_finite",
    "json_double",
    "ns_per_dollar",
    "path_group",
    "phase_label",
    "run_date_from_path",
    "run_id_from_path",
    "safe_divide",
    "strip_suffix",
]
