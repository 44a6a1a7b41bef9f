"""A small corpus with the awkward cases of every operator."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(words))


def rows() -> list[tuple]:
    rng = random.Random(5)
    passage = prose(rng, 60)
    base = prose(rng, 120).split()
    texts: list[str | None] = [
        None, "", "   \n\t ", "!!! ???", "Word", "two words", "é É ß 中文 字", "a\x1cb c d",
        passage, passage + " tail", "head " + passage + " tail here",
        prose(rng, 40) + " " + passage, passage + " " + passage,
        prose(rng, 34), prose(rng, 35),
    ]
    same = prose(rng, 80)
    texts += [same] * 4 + [same.upper()]
    for edit in range(12):  # near copies of one another, at different distances
        copy = list(base)
        for _ in range(edit):
            copy[rng.randrange(len(copy))] = "edit%d" % rng.randrange(1000)
        texts.append(" ".join(copy))
    texts += ["x y z " * 50, "loop " * 100, "line one here\nline one here\nother\n" * 5]
    texts += [prose(rng, rng.randint(1, 200)) + ".\n" + prose(rng, 30) for _ in range(25)]
    texts.append(prose(rng, 9000))
    langs = ["en", "fr", None]
    out = [(i + 1, t, langs[i % 3], f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out.append(out[20])  # a repeated row
    out.append((None, texts[30], None, None, None))  # a row without an id
    out.append((None, "no id and nothing like it", None, None, None))
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
