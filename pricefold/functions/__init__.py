from pricefold.functions.odds import (  # noqa: F401
    implied_prob_sum, invalid_reason, is_arbitrage, now_ms, profit_margin, stake,
    valid_price, valid_prices,
)
from pricefold.functions.text import (  # noqa: F401
    blank_to_null, build_match_id, clean_team, epoch_ms, file_stem_parts, iso_date,
    parse_kickoff,
)
