"""Small odd documents for the operators, and plain versions to hold them against."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score int, version int, line_no int"


def odd_texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = " ".join(rng.choice(words) for _ in range(300))
    near = base.replace(" w7 ", " changed ")
    lines = "\n".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(30))
    return [
        None, "", " \t\n ", "one", "two words", "ONE", base, base, near, base + " tail of it", lines,
        lines + "\n" + lines, "\n\n\n", "ééé ñandú straße ÉÉÉ", "日本語のテキスト", "x" * 5000, base * 40,
        "a\x0bb\x0cc\rd\x1ce", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "😀 " * 50 + base[:700],
    ]


def odd_documents(spark, texts=None):
    """Nulls in every column, a repeated row, a doc_id with two texts, and clashing extra columns."""
    texts = odd_texts() if texts is None else texts
    rows = [(i, t, ["en", "de", None][i % 3], ["s0", None][i % 2], None if t is None else len(t), i, i, i)
            for i, t in enumerate(texts)]
    rows += [rows[6], (3, "another text under a known number", "en", "s0", None, 0, 0, 0)]
    return spark.createDataFrame(rows, DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
