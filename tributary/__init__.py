"""tributary: keyed event streams and the tables they maintain, on Spark.

Every operator is a ``DataFrame -> DataFrame`` function that gives the same
answer on a batch table and on a Structured Streaming source.
"""

from .functions.avro import from_avro_column, to_avro_column
from .functions.columns import (birth_year, colour_code, day_kind, display_status, display_temperature,
                                display_train, line_colour, slug, step_entries, transform_station,
                                valid_customers, whole_rides)
from .functions.decode import (check_constraints, decode_avro, decode_base64_json, decode_json,
                               dead_letters, decode_message, decode_station, decode_summary, encode_json,
                               encode_record, first_element, positioned, split_malformed, unbase64_text,
                               well_formed)
from .operators.joins import expected_entries, join_risk, status_board
from .operators.order import order_board, order_stops, union_lines
from .operators.state import (current_weather, first_by_name, latest_by_key, running_count, slot_occupancy,
                              upsert_count)
from .operators.window import line_topology, ordered_neighbours
from .session import checkpoint_root, get_session

__version__ = "0.1.0"
