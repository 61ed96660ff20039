import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
BLOCKED = """
import sys, warnings
sys.path.insert(0, {root!r})
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Missing())
warnings.simplefilter("ignore")
import __spark_entry__ as entry
assert entry.queries() and set(entry.queries()) == set(entry.climate_queries())
assert set(entry.oracle_sql()) == set(entry.climate_sql())
"""


def imported_without(name):
    code = BLOCKED.format(root=str(ROOT), name=name)
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)


def test_a_missing_library_leaves_the_climate_queries():
    done = imported_without("public_tokenizers")
    assert done.returncode == 0, done.stderr


def test_missing_folders_leave_the_climate_queries():
    for name in ("gridclimate.llm", "corpus_pipeline"):
        done = imported_without(name)
        assert done.returncode == 0, done.stderr
