import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from commentlens.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def comments():
    """Own sentences over the three labels, with planted faults; counts below are worked out by hand.

    39 rows: 1 invalid label, 4 unusable texts, 1 exact copy, 1 text equal only after cleaning.
    """
    good = [f"I strongly support measure number {i} and its goals" for i in range(14)]
    bad = [f"This harmful plan number {i} burdens small lenders" for i in range(11)]
    flat = [f"Please clarify section {i} of the draft document" for i in range(7)]
    rows = [(t, "Positive") for t in good] + [(t, "Negative") for t in bad] + [(t, "Neutral") for t in flat]
    rows += [
        ("", "Positive"),
        ("   ", "Negative"),
        (None, "Neutral"),
        ("?!...", "Neutral"),
        ("An undecided remark on the rule", "Mixed"),
        (good[0], "Positive"),
        (good[1] + "  ", " Positive "),
    ]
    return [(i, text, label) for i, (text, label) in enumerate(rows)]
