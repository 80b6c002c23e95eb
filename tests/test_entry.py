import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_core_does_not_need_the_llm_package():
    code = "import sys; sys.modules['manualmill.llm'] = None; import __spark_entry__ as e; assert e.queries() and not any(k in e.queries() for k in ('p1_found', 'p3_found')); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_core_never_imports_it():
    for p in (ROOT / "manualmill").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "manualmill.llm" not in p.read_text() and "import llm" not in p.read_text(), p


def test_every_sql_has_a_query():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60
