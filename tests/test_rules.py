"""Source-level guards for the build rules: no cross joins, no local
checkpoints, no Python UDFs, no RDD escapes, nothing pulled whole to the
driver inside the library."""

from __future__ import annotations

import pathlib
import re

import pytest

LIB = pathlib.Path(__file__).resolve().parent.parent / "dayledger"


def sources():
    """The library's files but for the optional training-data operators, whose
    style is free."""
    return (p for p in LIB.rglob("*.py") if "llm" not in p.relative_to(LIB).parts[:1])


FORBIDDEN = {
    "cross join": r"\.crossJoin\(",
    "local checkpoint": r"localCheckpoint",
    "python udf": r"\bF\.udf\b|@udf\b|pandas_udf|applyInPandas|mapInPandas",
    "rdd escape": r"\.rdd\b|mapPartitions",
    "whole frame to the driver": r"\.toPandas\(",
}


@pytest.mark.parametrize("rule", sorted(FORBIDDEN))
def test_library_source_follows_the_rule(rule):
    bad = []
    for path in sources():
        for no, line in enumerate(path.read_text().splitlines(), 1):
            code = line.split("#", 1)[0]
            if re.search(FORBIDDEN[rule], code):
                bad.append(f"{path.relative_to(LIB.parent)}:{no}: {line.strip()}")
    assert not bad, bad


def test_driver_collects_are_bounded():
    """Every ``collect()`` in the library follows a ``limit`` (evidence rows)."""
    for path in sources():
        for no, line in enumerate(path.read_text().splitlines(), 1):
            if ".collect()" in line.split("#", 1)[0]:
                assert ".limit(" in line, f"{path}:{no}: {line.strip()}"
