"""How a row finds its range."""

import io
from contextlib import redirect_stdout

from pricelens.functions import ordering as O


def test_a_range_is_found_by_halving(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        O.ranged(spark.range(1000), ["id"]).explain()
    assert "aggregate([1024,512" in out.getvalue() and "min(struct" not in out.getvalue()
