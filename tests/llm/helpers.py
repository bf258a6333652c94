"""Small tables with awkward rows, and the plain versions that results are held against."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def awkward_texts(seed=7, n=40):
    """Nulls, empty and blank texts, ties, copies, near copies, shared passages, one long text, several scripts."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Größe", "日本", "été", "alpha", "Beta", "gamma", "delta", "x", "yy", "🙂", "naïve", "42", "end."]
    sentence = lambda k: " ".join(rng.choice(vocabulary) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(k))
    passage, texts = sentence(60), [None, "", "   \n\t ", "one", "one two", "a b c d"]
    texts += [sentence(rng.randint(5, 80)) for _ in range(n)]
    texts += [texts[10], texts[10], texts[11]]
    texts += [texts[12] + " tail", "head " + texts[12], f"{sentence(5)}\n{passage} {sentence(7)}", f"{passage}\x0b{sentence(3)}", sentence(9) + " " + passage]
    texts += ["ab" * 150, "abab" * 80, sentence(3000), "z" * 260]
    near = texts[20].split()
    texts += [" ".join([*near[:-1], "other"])]
    return texts


def table(spark, texts, ids=None, extra=True):
    """doc_id, text and columns whose names clash with those used inside the operators."""
    ids = list(range(len(texts))) if ids is None else ids
    names = "doc_id long, text string, source string, lang string, n_chars long"
    clash = ["g", "b", "payload", "kind", "rest", "kept", "copies", "copy", "doc", "tokens", "host", "gone_id"] if extra else []
    rows = [(i, t, f"s{k % 3}" if k % 7 else None, "en", len(t or ""), *["x"] * len(clash)) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, ", ".join([names, *(f"{c} string" for c in clash)])).repartition(3)


def words(text):
    return WORD.findall(text or "")
