"""Small tables with every odd case, and plain versions of what the operators compute."""

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, f string, h string, row string, mix_pass int"


def documents(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", None, "r", 7) for i, t, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def sentences(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(30, 80))).capitalize() + "." for _ in range(n)]


def odd_rows(seed=1):
    """(doc_id, text, source): nulls, empties, copies, repeated rows, ties and a long text."""
    plain = sentences(seed, 12)
    near = plain[0].replace(plain[0].split()[3], "changed", 1)
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(plain)]
    rows += [(20, plain[0], "s0"), (21, near, "s0"), (22, "", "s1"), (23, None, None), (24, " \n\t", "s1")]
    rows += [(25, plain[1], "s2"), (25, plain[1], "s2"), (None, plain[2], "s2"), (None, None, None)]
    rows += [(26, "\n".join(sentences(seed + 1, 400)), "s0"), (27, "ÀÉ ß 日本 \U0001f600 " * 40, "s1"), (28, "a", "s1")]
    rows += [(29, "x" * 5000, "s1"), (30, "\n".join([plain[3], plain[4]]), "s1")]
    return rows


def groups(links, nodes):
    """The smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
