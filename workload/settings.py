"""Values that a query and its SQL have in common."""

import datetime as dt

from joinwright.plans.chain import Step

SEED = 7
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
DAYS = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))
INTS = (0, 1999999999)
PRICES = (10.0, 99.5)
CODE = "?##-??#"
FILTERED = "premium AND segment <> 'BUILDING'"
CHAIN_SIZES = (15000, 60001)
X1_STEPS = (
    Step(("c_custkey", "o_custkey"), "left"),
    Step(("o_orderkey", "l_orderkey"), "right"),
)
