"""The entry keeps the core keys when the optional part, or a package that it needs, is missing."""
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
KEYS = """
import sys
for name in {hidden!r}:
    sys.modules[name] = None       # importing it raises ImportError
import __spark_entry__ as E
from ridelake.queries import REGISTRY
print(len(E.queries()) - len(REGISTRY), len(E.oracle_sql()) - len(E.all_sql()), E.HAS_LLM)
"""


@pytest.mark.parametrize("hidden, whole", [([], True), (["ahocorasick"], False), (["xxhash"], None), (["ridelake.llm"], False), (["corpus_pipeline"], False)])
def test_core_keys_survive(hidden, whole):
    out = subprocess.run([sys.executable, "-c", KEYS.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    more, sql, has = out.stdout.split()
    if not os.path.isdir(os.path.join(ROOT, "ridelake", "llm")) or whole is False:
        assert (more, sql, has) == ("0", "0", "False")
    elif whole:
        assert has == "True" and int(more) > int(sql) > 0
