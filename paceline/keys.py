"""Column groups that identify the rows of the domain tables."""

VENUE_DAY = ["race_date", "place_code"]
RACE = ["race_date", "place_code", "race_no"]
CAR = RACE + ["car_no"]
MARKET = RACE + ["bet_type"]
COMBO = RACE + ["bet_type", "kumi_ban"]

# Fixed values of the domain.
BET_TYPES = ["WH2", "WT2", "SH2", "ST2", "RH3", "RT3", "W"]
ORDERED_BETS = ["ST2", "WT2", "RT3"]
CAPTURE_OFFSETS = [5.0, 3.0, 2.0, 1.0, 0.5]


def in_race(*more: str):
    """Window over one race (or a group inside it); needs an active session."""
    from pyspark.sql import Window

    return Window.partitionBy(*RACE, *more)
