import json

import pytest

from sigmill.plans.scoring_queries import BOOK
from sigmill.sources import configs as C


def test_documents(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps(BOOK))
    assert C.load_codebook(str(tmp_path / "b.json")) == BOOK
    (tmp_path / "x.json").write_text(json.dumps(BOOK | {"version": "1"}))
    with pytest.raises(ValueError):
        C.load_codebook(str(tmp_path / "x.json"))
    (tmp_path / "o.json").write_text(json.dumps({"signals": [{"signal_path": "phone", "value_type": "bool"}, {"signal_path": "web", "value_type": "bool", "deprecated_in": "1.1.0"}]}))
    unknown, old = C.book_against_ontology(BOOK, C.load_ontology(spark, str(tmp_path / "o.json")))
    assert unknown == ["category", "emails", "listings", "provenance"] and old == ["web"]


def test_small_things(spark):
    assert C.merge_brief("---\na: 1\nb: \"x y\"\n---\ntext", "---\na: 2\n---") == {"a": "2", "b": "x y"} and C.merge_brief("", "no") == {}
    df = spark.createDataFrame([("/x/pages_2025h2.db",), ("/x/core_2024.db",), ("/x/readme",)], "path string")
    assert {tuple(r)[1:] for r in C.stored_periods(df).collect()} == {("pages", 2025, "h2"), ("core", 2024, None)}
    assert C.markdown(spark.createDataFrame([("a|b", None)], "k string, v int")).splitlines()[-1] == "| a\\|b | – |"
    with pytest.raises(ValueError):
        C.markdown(df, 2)
