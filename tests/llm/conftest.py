import pytest

LONG = ("lorem ipsum dolor " * 12000).strip()

TEXTS = {
    1: "Hello world, it's 2024 — naïve café.",
    2: None,
    3: "",
    4: " \t\n\x0b ",
    5: LONG,
    6: "日本語 😀 text ٣ <|endoftext|> İstanbul",
    7: "the cat sat on the mat with the hat\nthe cat sat on the mat with the hat\nend",
    8: "Mail a.b@c.example.org or +1 (555) 123-4567, card 4111 1111 1111 1111, ip 10.0.0.300 and 10.0.0.3.",
}

#: Columns that the operators use themselves.
CLASHES = "ids string, n_tokens int, score string, predicted string, kept string, base_failed string, spans int, base_spans int, fingerprint int, component_id int, digest int, content int, code int, vertex int, n_words int, _words int, _added int, rejected_by int, TOXIC int"


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in TEXTS.items()]
    rows += [rows[0], (9, TEXTS[1], "en", "s", 1), (None, "no id at all here", "en", "s", 3)]
    extra = [None] * len(CLASHES.split(","))
    return spark.createDataFrame([(*r, *extra) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
