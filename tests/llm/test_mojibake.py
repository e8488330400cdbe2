"""Garbled text: round trips and texts that only look odd."""

import pytest

from strataline.llm.mojibake import cost, repair, repair_texts

TEXTS = ["The naïve reading — cost €5 per m² — doesn’t hold near Sølgate.", "Die Lösung stützt den Schlüsselwert gemäß den Größen.", "L’écluse fermée dépasse le réseau d’égouts à débit constant.", "Старая плотина покрывает процентную ставку за короткое время.", "在干旱季节，共振箱推迟了冷藏仓库。", "両岸に沿って織機は早い開花を変える。", "ในฤดูแล้งชั้นดินเหนียวปกคลุม"]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("read", ["cp1252", "latin-1"])
def test_utf8_once_and_twice(text, read):
    def garble(t):
        return "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in t.encode("utf-8"))

    once = garble(text)
    assert repair(once)[:2] == (text, True)
    if text.startswith(("The", "Die", "L’")):
        assert repair(garble(once))[0] == text and repair(garble(once))[2] == 2


@pytest.mark.parametrize("written,read,text", [("cp1251", "cp1252", TEXTS[3]), ("koi8-r", "cp1251", TEXTS[3]), ("mac_roman", "cp1252", TEXTS[2]), ("cp437", "cp1252", "Das Geräusch stützt die Lösung."), ("utf-8", "mac_roman", TEXTS[1]), ("utf-8", "cp437", TEXTS[1]), ("utf-8", "cp1251", TEXTS[0])])
def test_other_pairs_are_found(written, read, text):
    bad = "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in text.encode(written))
    assert repair(bad)[1]


@pytest.mark.parametrize("text", [*TEXTS, "Naïve café, Å–Ærø, SÃO Velmo, Âr, 25 °C ± 3 µm, €4½.", "AS AÇÕES DE SÃO VELMO subiram", "a &amp; b &eacute;", "●●● ▯▯▯Ω ��� □□x ◆◆3 ��Ω", "", "  ", "plain", "été", "🌊🌾 ✅ 👩‍🌾", "É… Ü“ „Fuß“"])
def test_ordinary_text_stays(text):
    assert repair(text) == (text, False, 0)


def test_lost_characters():
    assert repair("El a�o seco detendr� la poblaci�n")[1] and repair(None) == (None, False, 0)
    assert cost(TEXTS[0]) == 0


def test_rows(spark):
    rows = [(1, "KÃ¶ststead", "x"), (2, None, "y"), (3, "", None), (4, "é" * 100_000, "z"), (1, "KÃ¶ststead", "x")]
    got = sorted((r.doc_id, (r.repaired or "")[:9], r.garbled) for r in repair_texts(spark.createDataFrame(rows, "doc_id int, text string, layers string")).collect())
    assert got == [(1, "Köststead", True), (1, "Köststead", True), (2, "", False), (3, "", False), (4, "é" * 9, False)]
    assert repair_texts(spark.createDataFrame([], "doc_id int, text string")).count() == 0


@pytest.mark.parametrize("text", ["naïve", "Lösung"])
def test_any_number_of_layers(text):
    bad = text
    for n in range(1, 13):
        bad = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in bad.encode("utf-8"))
        assert repair(bad) == (text, True, n)
