"""Readers against a plain-Python model of the line rules, on random lines."""

import re
import uuid
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quiver.sources import read_edges

ID = re.compile(r"^[+-]?[0-9]+$")


def jvm_split(line, sep=","):
    """``String.split(sep)``: trailing empty fields removed; "" -> [""]."""
    if line == "":
        return [""]
    parts = line.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def as_id(token):
    if not ID.match(token):
        return None
    value = int(token)
    return value if -(2**63) <= value < 2**63 else None


def model(lines, rule):
    out = Counter()
    for line in lines:
        if rule == "tokenised":
            tokens = [t for t in line.split(",") if t]
            for i in range(1, len(tokens), 2):
                v = as_id(tokens[i])
                if v is not None:
                    out[(v,)] += 1
            continue
        parts = jvm_split(line)
        if (rule == "strict" and len(parts) != 2) or (rule == "lenient" and len(parts) < 2):
            continue
        a, b = as_id(parts[0]), as_id(parts[1])
        if a is not None and b is not None:
            out[(a, b)] += 1
    return out


lines_strategy = st.lists(
    st.text(alphabet="0123456789,,,+-x", min_size=0, max_size=10), min_size=1, max_size=30
)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=lines_strategy, rule=st.sampled_from(["strict", "lenient", "tokenised"]))
def test_reader_matches_model(spark, tmp_path, lines, rule):
    folder = tmp_path / uuid.uuid4().hex
    folder.mkdir()
    (folder / "part.txt").write_text("\n".join(lines) + "\n")
    got = Counter(tuple(r) for r in read_edges(spark, str(folder), rule).collect())
    assert got == model(lines, rule)
