"""Column-expression building blocks (all JVM-side, inside whole-stage codegen)."""

from hackney.functions.display import preview, report
from hackney.functions.geo import haversine_km, register_sql_functions
from hackney.functions.numeric import mean_of, round_to, sum_parts, to_units, total_of, with_parts
from hackney.functions.ordering import pack, unpack_low, with_order_key
from hackney.functions.timefn import elapsed_minutes, elapsed_seconds, in_hour_window, is_night, pickup_hour

__all__ = [
    "haversine_km", "register_sql_functions", "mean_of", "round_to", "sum_parts", "to_units", "total_of", "with_parts",
    "elapsed_minutes", "elapsed_seconds", "pack", "unpack_low", "with_order_key", "in_hour_window", "is_night", "pickup_hour", "preview", "report",
]
