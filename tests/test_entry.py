"""The driver's entry without a library that the optional subpackage needs."""

import os
import subprocess
import sys

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(blocked: str) -> set[str]:
    """Query names that register where a module cannot be imported."""
    code = f"import sys; sys.modules[{blocked!r}] = None; sys.path.insert(0, {HOME!r}); import __spark_entry__ as E; print(*E.queries(), *('sql:' + n for n in E.oracle_sql()))"
    return set(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())


def test_core_queries_stay_without_the_subpackage():
    whole, part = names("no_such_module"), names("churnwatch.llm")
    assert {"drift_report", "alert_for_all", "sql:drift_report"} <= part <= whole
    assert not any(n.startswith("op") and n[2].isdigit() for n in part) and "pipeline" not in part


def test_core_queries_stay_without_a_library():
    part = names("tiktoken")
    assert "drift_report" in part
