from tiertrip.functions.numeric import pct, round_avg, round_sum, round_value  # noqa: F401
