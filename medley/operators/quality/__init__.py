"""The data-quality gate: rules from tables, one pass over the data, valid and held rows apart."""

from medley.operators.quality.gate import GateResult, gate
from medley.operators.quality.rules import Rule, select_rules, to_rules

__all__ = ["GateResult", "Rule", "gate", "select_rules", "to_rules"]
