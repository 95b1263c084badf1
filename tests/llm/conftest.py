import random

import pytest

from spendecho.llm.queries import QUERIES

SYLLABLES = ["ta", "ri", "mon", "el", "sha", "vo", "ki", "nur", "pe", "dos"]


def prose(seed, n):
    draw = random.Random(seed)
    return [
        "".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))) + draw.choice(["", "", "", ",", ".\n"]) for _ in range(n)
    ]


def edge_documents():
    """(doc_id, text, lang, source, n_chars) with NULLs, blanks, copies, a long text."""
    base, other = prose(1, 90), prose(2, 200)
    near = [*base[:40], "swapped", *base[41:]]
    passage = prose(3, 40)
    rows = [
        (0, " ".join(base), "xx", "b"), (1, " ".join(base), "xx", "b"), (2, " ".join(near), "xx", "b"),
        (3, None, "xx", "a"), (4, "", "yy", "a"), (5, " \n\t \x0b", "yy", None), (6, "Word", None, None),
        (7, "\n".join(prose(4, 5_000)), "yy", "hot"), (None, " ".join(other), "xx", ""), (None, None, None, None),
        (8, "ALL rights  Reserved. Licensed under CC-BY 4.0; see the general public license", "yy", None),
        (8, "ALL rights  Reserved. Licensed under CC-BY 4.0; see the general public license", "yy", None),
        (9, " ".join([*prose(5, 30), *passage, *prose(6, 30)]), "xx", "hot"),
        (10, " ".join([*prose(7, 60), *passage]), "xx", "hot"),
        (11, "a b c \x1c d Été \U0001f600 naïve", "yy", "a"), (12, "123 456 7", "yy", "a"),
        (13, "\n".join(["same line of words"] * 40), "yy", "junk"), (14, "### $$$ &&& " * 30, "yy", "junk"),
        (15, "x" * 5000 + " " + "y" * 40, "xx", "b"), (-3, " ".join([*passage, *other]), "xx", "\U0001f600"),
        *[(100 + i, " ".join(prose(50 + i, 120)), "xx" if i % 2 else "yy", "hot") for i in range(12)],
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def edge_benchmark():
    passage = " ".join(prose(3, 40))
    return [(1, passage.upper()), (2, " ".join(prose(99, 30))), (3, None), (4, ""), (None, "Word"), (5, "naïve"), (1, passage)]


def edge_pages():
    urls = [
        None, "", "no scheme", "http://", "http://ORG/x", "https://Example.ORG/es/a?b", "http://a.example.org/en/1",
        "http://example.org", "http://xorg/", "ftp://com/de/", "http://de.com/fr/#x", "http://me@com:80/de/", "http://com?/de/",
        "http://b.a.example.org/en/12/", "http://b.a.example.org/en/2", "http://org./", "http://..org/", "://org/", "http://example.com/de",
        "http://example.com/DE/", "http://com/fr/é", "http://com/fr/é",
    ]
    return [(i if i % 7 else None, u, "<html>") for i, u in enumerate(urls)]


def edge_vectors():
    """Copies, ties, NULLs, components that are none, another dimension, huge values, few labels."""
    draw = random.Random(11)
    centres = [[draw.gauss(0, 0.3) for _ in range(8)] for _ in range(40)]
    vectors = [[c + draw.gauss(0, 0.05) for c in draw.choice(centres)] for _ in range(420)]
    rows = [(i * 3 % 1000, v, i % 4 if i % 5 else None) for i, v in enumerate(vectors)]
    rows += [(500 + i, vectors[7], 1) for i in range(60)]
    rows += [(None, vectors[3], None), (1, vectors[4], 9), (1, vectors[4], 9), (1, vectors[5], 9), (2000, None, 1)]
    rows += [(2001, [0.1] * 7 + [None], 1), (2002, [0.1] * 7 + [float("nan")], 1), (2003, [0.1] * 7 + [float("-inf")], 1)]
    return [*rows, (2004, [0.1] * 3, 1), (2005, [], 1), (2006, [1e30, -1e30] * 4, 2), (2007, [0.0] * 8, 2), (2008, [-0.0009765625, 0.0009] * 4, 2)]


def edge_turns():
    """Shared beginnings, copies, prefixes of others, marks and escapes inside, ties, NULLs, one long conversation."""
    start = [("system", "be brief"), ("user", "hello"), ("assistant", "hi <turn>")]
    talks = {
        0: start, 1: [*start, ("user", "more"), ("assistant", "yes")], 2: [*start, ("user", "else"), ("assistant", "no")], 3: start,
        4: [*start[:2], ("assistant", "other")], 5: [("user", "")], 6: [("user", None), ("assistant", None)], 7: [(None, "x"), ("", "x")],
        8: [("a\nb", "</turn>\n<turn>user\n"), ("assistant", "\\l \\\\ \\</turn>")], 9: [("us", "er"), ("user", "")], 10: [("user", "er")],
        11: [*start[1:], *start[1:]], 12: [("user" if i % 2 else "assistant", f"turn {i % 7}") for i in range(700)],
        13: [("user" if i % 2 else "assistant", f"turn {i % 7}") for i in range(350)], 14: [("assistant", "\U0001f600 é\r\x00\u2028")],
        15: [("user", "word " * 20_000), ("assistant", "x" * 30_000)], **{20 + i: [*start[:1], ("user", f"q{i % 9}"), ("assistant", "same")] for i in range(40)},
    }
    rows = [(c, i, r, t) for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    return [*rows, (70, 1, "user", "b"), (70, 1, "user", "a"), (70, 1, "assistant", "z"), (70, None, "user", "first"), (70, 1, "user", "a"), (None, 0, "user", "lost"), (None, 3, "assistant", "found")]


CLASHING = {"size": "long", "n_words": "string", "kept": "long", "spans": "string", "score": "string", "host": "string", "row": "long"}


def tables(spark, folder, documents, benchmark, pages, labels, vectors, turns):
    clash = ", ".join(f"{n} {t}" for n, t in CLASHING.items())
    empty = (None,) * len(CLASHING)

    def save(name, rows, schema, extra=True):
        rows = [(*r, *(empty if extra else ())) for r in rows]
        spark.createDataFrame(rows, f"{schema}, {clash}" if extra else schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    save("documents", documents, "doc_id long, text string, lang string, source string, n_chars long")
    save("benchmark", benchmark, "item_id long, text string", extra=False)
    save("pages", pages, "page_id long, url string, html string")
    save("embeddings", vectors, "vec_id long, embedding array<float>, label int")
    save("conversations", turns, "conv_id long, turn long, role string, text string")
    save("labels", labels, "doc_id long, quality int, toxic int", extra=False)
    return str(folder)


@pytest.fixture(scope="session")
def edges(spark, tmp_path_factory):
    labels = [(i, int(i not in (13, 14)), 0) for i in [*range(16), *range(100, 112)]] + [(3, None, None), (0, 1, 0), (999, 0, 0)]
    return tables(spark, tmp_path_factory.mktemp("edges"), edge_documents(), edge_benchmark(), edge_pages(), labels, edge_vectors(), edge_turns())


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("nothing"), [], [], [], [], [], [])


@pytest.fixture(scope="session")
def result(spark):
    """Rows of a query, run once per folder."""
    held = {}

    def of(name, folder):
        if (name, folder) not in held:
            held[name, folder] = QUERIES[name](spark, folder).collect()
        return held[name, folder]

    return of
