"""The entry file imports whatever is missing for the optional part, and the shared folder is never machine-local on a cluster."""

import os
import subprocess
import sys

import pytest

from tiergrain import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; from tiergrain.plans.registry import REGISTRY as r; " \
        "assert set(r) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries()); print('llm', e.llm is not None)"


def run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)


@pytest.mark.parametrize("module", ["public_tokenizers", "ahocorasick", "regex", "xxhash", "corpus_pipeline", "tiergrain.llm"])
def test_entry_imports_without_an_optional_module(module):
    there = os.path.exists(os.path.join(ROOT, "tiergrain", "llm", "__init__.py"))
    done = run(f"import sys; sys.modules[{module!r}] = None; {COUNT}")
    if module == "tiergrain.llm" and there:       # a part that is there and does not import is an error
        assert done.returncode
    else:
        assert done.returncode == 0 and done.stdout.strip() == "llm False", done.stderr


class _Context:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return "set"


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), self
        self.set = lambda k, v: None

    def get(self, key, default):
        return default


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"])
def test_a_cluster_needs_its_shared_folder(master):
    with pytest.raises(RuntimeError):
        session.checkpoint_root(_Session(master))


@pytest.mark.parametrize("master", ["local", "local[*]", "local[4]", "local[4,2]"])
def test_a_local_master_gets_a_folder(master):
    assert session.checkpoint_root(_Session(master))
