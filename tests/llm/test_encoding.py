import random

import pytest

from sigmill.llm.encoding import damaged_values, inspect, quick, restore_spans

TEXTS = ["Bäckerei Müller", "Groß Königsburg", "Straße 5", "KÖNIGSPLATZ ÄÖÜ", "Łąka Garten", "Café – Décor", "Señal Übung"]


@pytest.mark.parametrize("shown", ["cp1252", "cp437", "cp850", "cp1251", "mac_roman"])
@pytest.mark.parametrize("text", TEXTS)
def test_round_trip_of_multibyte_spans(text, shown):
    raw = text.encode("utf-8")
    try:
        garbled = raw.decode(shown)
    except UnicodeDecodeError:
        garbled = "".join(bytes([b]).decode(shown, "ignore") or chr(b) for b in raw)
    assert restore_spans(garbled) == (text, True)


def test_twice_encoded_utf7_and_bom():
    assert restore_spans("Müller".encode().decode("cp1252").encode().decode("cp1252")) == ("Müller", True)
    assert restore_spans("M+APw-ller") == ("Müller", True) and restore_spans("A+B-C") == ("A+B-C", False)
    assert restore_spans("ï»¿Bau") == ("Bau", True)


@pytest.mark.parametrize("text", TEXTS + ["", "Holz³ Bau", "Wer baut? Wir!", "„Zum Hobel“ GmbH", "Plan§ Dach™", "±0 Estrich", "日本語", "Привет мир", "Bäckerei…", "???", "x" * 50_000])
def test_right_text_is_left_alone(text):
    assert restore_spans(text) == (text, False)
    assert not inspect(text)[1]


@pytest.mark.parametrize("garbled", ["M³hlbach", "St÷rche", "Krдhen", "S”hne", "M\x81hle", "Stra▀e", "M�hle", "?bung", "Gr?n", "ST…RCHE"])
def test_signs_in_wrong_places(garbled):
    assert inspect(garbled)[1]


def test_quick_restores_one_byte_confusions():
    assert quick("Klein Mⁿhlbⁿttel") == "Klein Mühlbüttel" and quick("Holz³ Zimmerei") == "Holz³ Zimmerei" and quick("Señal Licht") == "Señal Licht"


def test_corpus_decides_at_word_ends(spark):
    rows = ["Groß Ammer"] * 30 + ["Plan§ Bau"] * 20 + ["Gro§ Ammer", "Gro? Ammer", "Holz³ Bau"] + ["Holz³ Bau"] * 10 + [None, "", "Wer baut? Wir!"] * 5
    df = spark.createDataFrame([(r, 1) for r in rows], "value string, n int").repartition(5)
    got = {r.value: (r.restored, r.bad) for r in damaged_values(df).collect()}
    assert got["Gro§ Ammer"] == ("Groß Ammer", True) and got["Gro? Ammer"][1]
    assert not any(got[v][1] for v in ("Plan§ Bau", "Holz³ Bau", "Wer baut? Wir!"))
    assert damaged_values(df.limit(0)).count() == 0
