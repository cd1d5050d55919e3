"""Which regular expressions may run deep.

Java matches a repeated group by recursion, a level per round, and a long text
then ends the thread's stack, which Spark takes for the end of the executor. A
pattern with such a group runs by a call that gives null instead.
"""

from __future__ import annotations

import re

# Rounds of a group that are certain to fit on a stack.
FEW_ROUNDS = 50

_REPEAT = re.compile(r"\*|\+|\{\d+,\}|\{(\d+)(?:,(\d+))?\}")


def runs_deep(pattern: str) -> bool:
    """Whether a group of the pattern is repeated more than ``FEW_ROUNDS`` times or without a bound."""
    if re.search(r"\(\?[a-zA-Z]*x", pattern):  # blanks and comments may stand anywhere
        return True
    at, classes = 0, 0
    while at < len(pattern):
        if pattern.startswith("\\Q", at):
            end = pattern.find("\\E", at)
            at = len(pattern) if end < 0 else end + 2
            continue
        c = pattern[at]
        at += 2 if c == "\\" else 1
        if c == "[":
            classes += 1
        elif c == "]" and classes:
            classes -= 1
        elif c == ")" and not classes:
            m = _REPEAT.match(pattern, at)
            if m and (m.group(1) is None or int(m.group(2) or m.group(1)) > FEW_ROUNDS):
                return True
    return False
