"""The command line writes the same itemsets as the library."""

import os
import tempfile

from cofreq.__main__ import main

from conftest import fixture_path


def _lines(spark, path):
    return sorted(r["value"] for r in spark.read.text(path).collect())


def test_cli_apriori_exact_k(spark, capsys):
    out = os.path.join(tempfile.mkdtemp(prefix="cofreq-test-"), "a")
    assert main(["apriori", fixture_path("simple.txt"), "2", "--k", "3", "--out", out]) == 0
    assert _lines(spark, out) == ["1 2 3: 2", "1 2 5: 2"]
    assert "2 itemsets" in capsys.readouterr().out


def test_cli_go_on_and_fraction(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="cofreq-test-"), "e")
    assert main(["eclat", fixture_path("synthetic50.txt"), "0.1", "--k", "3", "--go-on",
                 "--out", out]) == 0
    assert len(_lines(spark, out)) == 32          # 31 triples + 1 four-item set
