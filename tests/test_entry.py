"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

from conftest import ROOT


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_contract(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert df.columns == ["product_category", "page_name", "product_views", "added_to_cart",
                          "purchased_product", "abandoned_count"]
    assert df.count() > 0
    q, o = m.queries(), m.oracle_sql()
    core = {k for k in q if k in m.QUERIES}
    assert core <= set(o) <= set(q) and len(core) >= 92
    assert all(callable(f) for f in q.values())
    assert not [k for k in core if k.startswith("op") and k[2:3].isdigit()]
