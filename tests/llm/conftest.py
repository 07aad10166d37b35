import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))  # check_oracles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _text string, _n long, rid string, kept int"


def awkward_documents():
    """Nulls in all columns, empty and long texts, repeated rows, copies, near copies, shared passages."""
    pick = random.Random(7)
    words = ["wor" + "".join(pick.choice("aeioulnrst") for _ in range(5)) for _ in range(400)]

    def text(n, per_line=9):
        out = [pick.choice(words) for _ in range(n)]
        return "\n".join(" ".join(out[i:i + per_line]) for i in range(0, n, per_line))

    passage = "\n".join(text(9) for _ in range(5))
    texts = [None, "", " \n\t \n", "One", "two words", "a\nb\nc\na\nb\nc\n", "\u00c9t\u00e9 \U0001f600 na\u00efve\u00a0x " * 4, "1234 it's  IT'S\r\n\x0b\x0c x"]
    texts += [text(120) for _ in range(25)]
    texts += [text(40) + "\n" + passage + "\n\n" + text(40) for _ in range(6)]
    base = text(300).split(" ")
    for i in range(12):  # near copies
        near = list(base)
        near[(i * 17) % len(near)] = f"changed{i}"
        texts.append(" ".join(near))
    texts += [text(150)] * 9  # copies
    texts += [text(20) + " same old five words again" * 8]
    texts += [text(12_000), "x" * 60_000]
    rows = [(i, t, "en" if i % 3 else None, ["hot", "hot", "cold", None][i % 4], None if t is None else len(t), 0.1, "t", i, "r", 1)
            for i, t in enumerate(texts)]
    return [*rows, rows[10], rows[10]]


@pytest.fixture(scope="session")
def documents():
    return awkward_documents()


def _save(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="session")
def small(spark, tmp_path_factory, documents):
    """A folder of tables with the awkward documents."""
    folder = str(tmp_path_factory.mktemp("small"))
    _save(spark, folder, "documents", documents, SCHEMA)
    labels = [(r[0], i % 2, 0) for i, r in enumerate(documents) if r[0] % 5]
    _save(spark, folder, "labels", [*labels, (None, None, None), labels[0]], "doc_id long, quality int, toxic int")
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/en/12?x", "http://example.org/es/", "http://example.org/es", "http://org/",
            "http://notexample.org/es/1", "https://x.com/fr/a#b", "https://x.com/de/", "http://com/de/fr/", "http://com.x/de/", "x://y://z/de/"]
    pages = [(i, u, "t") for i, u in enumerate([*urls, urls[3]])]
    _save(spark, folder, "pages", pages, "page_id long, url string, verdict string")
    pick = random.Random(3)
    vectors = [[pick.gauss(0, 1) for _ in range(8)] for _ in range(300)]
    vectors[7], vectors[8], vectors[9], vectors[11] = None, [0.0] * 8, [float("nan")] * 8, [None] + [1.0] * 7
    vectors[13] = vectors[12]
    _save(spark, folder, "embeddings", [(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, cell int")
    return folder


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    """The same tables without rows."""
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                         ("labels", "doc_id long, quality int, toxic int"), ("pages", "page_id long, url string"),
                         ("embeddings", "vec_id long, embedding array<float>"), ("conversations", "conv_id long, turn long, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder
