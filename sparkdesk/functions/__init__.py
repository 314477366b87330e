from sparkdesk.functions.text import (card_mask, card_mask_pandas, iso_weekday, day_range,
                                      strip_ws)
from sparkdesk.functions.stats import safe_corr, round_half
from sparkdesk.functions.keys import hash_key

from sparkdesk.functions.stats import exact_avg, exact_sum

__all__ = ["exact_avg", "exact_sum", "card_mask", "card_mask_pandas", "iso_weekday", "day_range", "strip_ws",
           "safe_corr", "round_half", "hash_key"]
