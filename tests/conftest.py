import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from cellar.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp(spark):
    """A fresh folder per test (below the checkpoint folder, which tests may set themselves)."""
    from cellar.session import checkpoint_root

    root = checkpoint_root(spark)
    base = root[len("file:"):] if root.startswith("file:") else root
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix="test-", dir=base)
