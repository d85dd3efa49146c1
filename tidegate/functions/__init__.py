from .labels import customer_segment, direction
from .money import as_amount, average_half_up, exact, finite
from .parsing import normalise_name, parse_date, parse_timestamp, title_case

__all__ = ["as_amount", "average_half_up", "customer_segment", "direction", "exact", "finite", "normalise_name",
           "parse_date", "parse_timestamp", "title_case"]
