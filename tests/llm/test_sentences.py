"""Sentence boundaries."""

import pytest

from strataline.llm.sentences import language, spans, with_sentences

CASES = [
    ("en", "Dr. Ell noted it. “Not yet!” cried Zel as it fell. See Fig. 3.2, pp. 4–9, vs. 8.1 in Aug. When it rains, e.g. today, it pours.", 4),
    ("en", "By 6.44 a.m. the weir had gone. It costs 5.5 crowns at 5 p.m. Meanwhile it grew.", 3),
    ("en", "The A.T.C. board sees it. pH readings show it. J. N. Fal wrote it.One more.", 4),
    ("en", "The weir... or so it seemed – held. It fell… Then it rose.", 3),
    ("en", "“One thing happened. Another followed. A third came.” Then we left.", 4),
    ("en", "The clerk said “One thing happened. Another followed.” and the board left.", 1),
    ("en", "Line one\nruns on.\n\nNew part", 2),
    ("de", "Der Wert stieg um 5,1 v. H. gegenüber dem 4. Quartal. „Warum?“, fragte Prof. Ell. Das gilt z. B. für Öl usw. Am 7. Oktober regnet es.", 4),
    ("fr", "La rivière est là ! « Où donc ? » demanda M. Ell. Le sable, l’argile, etc. Voir p. 149.", 4),
    ("es", "En EE. UU. llueve mucho. ¿Por qué? El Sr. Ell dijo p. ej. nada según la fig. 4.", 3),
    ("pt", "NÃO há dúvida do Dr. Ell. A areia, etc. Depois disso, segundo a fig. 2, não chove.", 3),
    ("ru", "Старая плотина, т. е. река, растёт. «Почему?» — спросил проф. Кессин. Песок и т. д. Дождь идёт.", 4),
    ("zh", "塔尔文写道：“水涨了。”“为什么？”罗维恩教授问道。土壤……改变了。", 3),
    ("ja", "「なぜ変えるのか？」とメルドン教授は尋ねた。（地下水は高い。）川は…流れる。", 3),
    ("th", "น้ำใต้ดินป้องกันแนวตลิ่ง ตามรูปที่6.5เส้นด้ายบาง", 2),
    ("hi", "डॉ. ओस्किन ने कहा। क्या यह नदी है? हाँ।", 3),
]


@pytest.mark.parametrize("lang,text,count", CASES)
def test_count_and_language(lang, text, count):
    assert language(text) == lang
    assert [text[a:b] for a, b in spans(text)].__len__() == count, [text[a:b] for a, b in spans(text)]


@pytest.mark.parametrize("text", [c[1] for c in CASES] + ["", None, "  \n ", "a", "...", "\n\n", "(Open “quote", ") x. y", "Word. " * 20_000])
def test_spans_cover_all_but_space(text):
    out = spans(text)
    assert all(a < b for a, b in out) and all(x[1] <= y[0] for x, y in zip(out, out[1:]))
    held = "".join(text[a:b] for a, b in out) if text else ""
    assert "".join(held.split()) == "".join((text or "").split())
    assert all(not text[a].isspace() and not text[b - 1].isspace() for a, b in out)


def test_column(spark):
    df = spark.createDataFrame([(1, "One. Two.", "x"), (2, None, "y"), (3, "", None), (1, "One. Two.", "x")], "id int, content string, sentences string")
    got = with_sentences(df).collect()
    assert len(got) == 4 and sorted(len(r.sentences) for r in got) == [0, 0, 2, 2]
    assert [s.text for r in got for s in r.sentences if r.id == 1][:2] == ["One.", "Two."]
    assert with_sentences(df.filter("id > 9")).count() == 0
