import os
import subprocess
import sys

import __spark_entry__ as E

from labelsieve.plans import queries


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["arm", "pick", "frame_id", "video_id", "score"]


def test_every_query_of_the_core_has_an_oracle():
    q, o = set(E.queries()), set(E.oracle_sql())
    assert o <= q
    assert set(queries.QUERIES) == set(queries.ORACLE)


def test_core_queries_without_the_libraries_of_the_optional_part():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = ("import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; q = e.queries(); "
              "assert 'select_mined' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); "
              "assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", script], cwd=root, check=True, timeout=120)
