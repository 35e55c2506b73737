"""Documents that hold every awkward case, and small helpers of the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word(rng):
    return "".join(rng.choice("abcdefghilmnoprstuéß") for _ in range(rng.randint(1, 9)))


def awkward_documents(seed=5, n=60):
    """(doc_id, text): copies, near copies, shared passages, nulls, empty and white-space texts, ties, repeated rows, long texts."""
    rng = random.Random(seed)
    passage = " ".join(word(rng) for _ in range(70))
    line = " ".join(word(rng) for _ in range(55))
    out = []
    for i in range(n):
        words = [word(rng) for _ in range(rng.randint(1, 160))]
        if i % 5 == 0:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        if i % 7 == 0:
            words += line.split() + words[:3]
        out.append((i * 3, " ".join(words) + rng.choice(["", " ", "\n", "."])))
    out += [(200 + k, out[10][1]) for k in range(6)]  # copies
    near = out[20][1].split()
    for k in range(6):
        edited = list(near)
        edited[rng.randrange(len(edited))] = word(rng)
        out.append((300 + k, " ".join(edited)))
    out += [(400, None), (401, ""), (402, " \t\n"), (403, "  " + out[10][1].replace(" ", "\t\n")), (404, "the " * 300), (405, "the " * 280), (None, passage), (None, None)]
    out += [(500, out[12][1]), (500, out[12][1]), (501, out[13][1]), (501, out[14][1])]  # rows that repeat, and one id with two texts
    long = " ".join(word(rng) for _ in range(30_000))
    out += [(600, long), (601, "x" + long[1000:]), (602, "a" * 70_000), (603, "a" * 65_000), (604, "日本語 テキスト 😀     x" * 3), (-5, passage + " " + line)]
    return out


def frame(spark, rows, more=()):
    """documents table of (doc_id, text), with extra columns whose names operators use inside."""
    schema = SCHEMA + "".join(f", {c} string" for c in more)
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t), *["x" for _ in more]) for d, t in rows], schema).repartition(5)


CLASHING = ("doc", "th", "kind", "gram", "content", "starts", "n", "fp", "ids", "key", "digest", "salt", "least", "score", "x", "_mark", "_keep_id")
EMPTY = []
