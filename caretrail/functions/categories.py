"""Parsing and compiling the first-match-wins rulesets of :mod:`caretrail.rules`."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from caretrail import rules


@dataclass(frozen=True)
class Rule:
    test: str                 # eq | in | ilike | like
    patterns: tuple[str, ...]
    label: str


@dataclass(frozen=True)
class Ruleset:
    name: str
    rules: tuple[Rule, ...]
    lower_input: bool
    default: str | None

    @property
    def exact(self) -> list[tuple[str, int]]:
        """Each literal of the ``eq`` / ``in`` lines with the index of the first line naming it."""
        first: dict[str, int] = {}
        for i, r in enumerate(self.rules):
            if r.test in ("eq", "in"):
                for p in r.patterns:
                    first.setdefault(p, i)
        return list(first.items())

    @property
    def wildcards(self) -> list[tuple[int, Rule]]:
        return [(i, r) for i, r in enumerate(self.rules) if r.test in ("ilike", "like")]


def parse(name: str, text: str, lower_input: bool, default: str | None) -> Ruleset:
    out = []
    for line in text.strip("\n").split("\n"):
        test, pats, label = (x.strip() for x in line.split("|"))
        out.append(Rule(test, tuple(p.strip() for p in pats.split(";")), label))
    return Ruleset(name, tuple(out), lower_input, default)


TICKET_INCIDENTS = parse("ticket_incidents", rules.TICKET_INCIDENTS, True, rules.TICKET_INCIDENTS_DEFAULT)
CALL_INCIDENTS = parse("call_incidents", rules.CALL_INCIDENTS, True, rules.CALL_INCIDENTS_DEFAULT)
CALL_LINES = parse("call_lines", rules.CALL_LINES, False, rules.CALL_LINES_DEFAULT)


def prepared(value: Column, rs: Ruleset) -> Column:
    return F.lower(value) if rs.lower_input else value


def rule_test(v: Column, r: Rule) -> Column:
    """Boolean test of one line on the prepared value (NULL on NULL input)."""
    if r.test == "eq":
        return v == F.lit(r.patterns[0])
    if r.test == "in":
        return v.isin(*r.patterns)
    tests = [v.ilike(p) if r.test == "ilike" else v.like(p) for p in r.patterns]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def ladder(value: Column, rs: Ruleset) -> Column:
    """The ruleset as one searched CASE, line by line (reference form; used to cross-check)."""
    v = prepared(value, rs)
    expr = None
    for r in rs.rules:
        cond, lab = rule_test(v, r), F.lit(r.label)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr.otherwise(F.lit(rs.default).cast("string"))
