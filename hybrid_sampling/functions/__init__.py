from hybrid_sampling.functions.exact import (  # noqa: F401
    ceil_div,
    draw_index,
    final_size,
    half_up_div,
    interval_n,
    percent_to_bp,
    position_of,
    rand_to_micro,
    start_position,
)
from hybrid_sampling.functions.order import population_order, parity_keys  # noqa: F401
