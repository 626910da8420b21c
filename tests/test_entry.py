from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from pagelode.functions.words import LANGUAGES, stop_words

ROOT = Path(__file__).resolve().parent.parent

# A process that sees the installation without its archives and starts no JVM.
PROBE = """
import pathlib, sys
real = pathlib.Path.glob
pathlib.Path.glob = lambda self, pattern, **k: iter(()) if "jar" in str(pattern) else real(self, pattern, **k)
import __spark_entry__ as entry
names, sql = set(entry.queries()), entry.oracle_sql()
assert names and set(sql) <= names, set(sql) - names
assert "pyspark.ml" not in sys.modules
from pyspark import SparkContext
assert SparkContext._gateway is None
print(len(names))
"""


def test_entry_loads_without_archives_or_session():
    run = subprocess.run(
        [sys.executable, "-B", "-c", PROBE], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) > 50


@pytest.mark.parametrize("language", LANGUAGES)
def test_stop_words_equal_those_that_ship_with_spark(spark, language):
    remover = getattr(spark._jvm.org.apache.spark.ml.feature, "StopWordsRemover", None)
    try:
        shipped = list(remover.loadDefaultStopWords(language))
    except TypeError:
        pytest.skip("this installation lacks the class")
    assert stop_words(language) == tuple(sorted({w.lower() for w in shipped if w.isalpha()}))
