from tallybook.plans.oracles import ORACLES
from tallybook.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
