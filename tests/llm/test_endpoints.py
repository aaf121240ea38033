"""Endpoints of credentials against one plain pattern, and in time that grows with the text."""

import random
import re
import time

from hourloom.llm import secrets

PLAIN = re.compile(r"[a-z][a-z0-9+.-]*://[^\s\"'<>]{4,}", re.A)


def test_endpoints_against_a_plain_pattern():
    rng = random.Random(4)
    pieces = ["://", ":", "//", "/", "a", "b9", "Z", "+", ".", "-", " ", "\n", "<", "é", "http", "x", "0", "'"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert list(secrets._endpoints(text)) == [m.span() for m in PLAIN.finditer(text)], text


def test_long_runs_take_linear_time():
    start = time.time()
    for run in ("a", "0", "a-1.", "z://abcd"):
        assert sum(1 for _ in secrets._endpoints(run * 250_000 + " https://host.example/path")) >= 1
    assert time.time() - start < 20
