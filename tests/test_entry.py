import __spark_entry__ as entry


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


def test_entry_has_rows(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert "velocity_2d_mm" in out.columns


def test_the_rest_needs_no_llm_package():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    code = (
        "import sys, importlib.util as u\n"
        "real = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n.startswith(('framelake.llm', 'corpus_pipeline')) else real(n, *a)\n"
        "import __spark_entry__ as e\n"
        "assert not any(k.startswith('op') and k[2].isdigit() for k in e.queries())\n"
        "assert 'pipeline' not in e.queries()\n"
        "assert not any(m.startswith('framelake.llm') for m in sys.modules)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
