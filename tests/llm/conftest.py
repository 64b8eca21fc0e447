"""Small documents with every awkward case, shared by the tests of the text operators."""

import random

import pytest

KINDS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, row int, "
         "doc string, tie int, size string, words int, score string, `_row` int, h1 string")
SYLLABLES = {"en": ["the", "ing", "and", "ter", "ou", "sh"], "de": ["ei", "sch", "un", "ge", "ß"],
             "fr": ["eau", "é", "oi", "que", "re"]}


def prose(lang, words, seed):
    rng = random.Random(f"{lang}-{seed}")
    parts = SYLLABLES[lang]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(words)]
    return "\n".join(" ".join(out[i:i + 14]) for i in range(0, words, 14))


def rows():
    texts = []
    for i in range(90):
        lang = ("en", "de", "fr")[i % 3]
        texts.append((i, prose(lang, 30 + 7 * (i % 13), i), lang, f"s{i % 4}"))
    passage = prose("en", 60, "shared")
    for i in range(90, 110):    # one passage in many documents, otherwise their own text
        texts.append((i, f"{prose('en', 70, i)}\n{passage}\n{prose('en', 50, -i)}", "en", "s0"))
    for i in range(110, 125):   # exact and near copies of document 7
        base = texts[7][1].split(" ")
        if i % 3:
            base[i % len(base)] = "changed"
        texts.append((i, " ".join(base), "de", "s1"))
    texts += [(125, None, "en", "s0"), (126, "", None, None), (127, " \n\t \n", "fr", None),
              (128, "12 34 !! ??", "de", "s2"), (129, "word", "en", ""), (130, "a b c", "en", "s3"),
              (131, "x " * 5000 + "\n" + prose("en", 6000, "long"), "en", "s2"),
              (132, "Released under the MIT License.\nplain words here", "en", "s1"),
              (None, prose("fr", 40, "null id"), "fr", "s3"),
              (133, "İstanbul ﬁne ñandú 😀 <|endoftext|> it's", None, "s3"),
              (134, "a\x0bb\x0cc\rd\te  f\n\n\ng", "en", "s3"),
              (5, texts[5][1], "fr", "s1")]     # repeated row
    return [(i, t, lang, source, len(t or ""), 1, "d", 2, "z", 3, "q", 4, "h")
            for i, t, lang, source in texts]


@pytest.fixture(scope="session")
def records():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, records, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(records, KINDS).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], KINDS)
