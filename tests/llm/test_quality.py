import random
import re
from collections import Counter

from tallysheet.llm import quality as Q


def covered(words, n):
    count = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    return {j for i in range(len(words) - n + 1) if count[tuple(words[i:i + n])] > 1 for j in range(i, i + n)}


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    chars = sum(map(len, words))
    seen, n_dup, dup_chars, n_lines = set(), 0, 0, 0
    for line in text.split("\n"):
        of = re.findall(r"[^\x20\x09-\x0D]+", line)
        if of:
            n_lines += 1
            n_dup += line in seen
            dup_chars += (line in seen) * sum(map(len, of))
            seen.add(line)
    repeat = len(covered(words, 8))
    cover = {n: sum(len(words[i]) for i in covered(words, n)) for n in Q.COVERAGE}
    base = len(words) < 20 or 100 * repeat > 30 * len(words)
    kept = not base and dup_chars <= 0.20 * chars and all(cover[n] <= share * chars for n, share in Q.COVERAGE.items())
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), n_dup, repeat, base, kept, n_lines, dup_chars,
            *cover.values())


def run(df):
    return sorted((tuple(r) for r in Q.quality(df).collect()), key=str)


def test_random_texts_equal_brute_force(spark, documents_of):
    rng = random.Random(3)
    docs = [(0, None), (1, ""), (2, " \n\t"), (3, "ä" * 50), (4, "   x\x1c y\x85"), (5, "a  b " * 40), (5, "a  b " * 40)]
    for i in range(10, 90):
        words = [rng.choice(["the", "off", "é", "日本", "#", "a*b", "w%d" % rng.randint(0, 99)]) for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.6 and len(words) > 30:
            words[20:20] = words[:rng.randint(3, 15)]
        text = " ".join(words)
        if rng.random() < 0.3:
            text = "\n".join([text] * rng.randint(2, 4) + ["end"])
        docs.append((i, text.replace(" ", rng.choice([" ", "  ", "\n", "\x0b"]), 9)))
    expected = sorted(((d, *brute(t)) for d, t in docs), key=str)
    assert run(documents_of(docs, extra=("kept", "n_words"))) == expected
    assert {r[7] for r in expected} == {True, False}


def test_texts_of_a_chunk_do_not_touch_each_other():
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["a", "bb", "ccc"], k=rng.randint(0, 300))) for _ in range(80)]
    together = Q.measure(texts)
    assert list(zip(*(together[c].tolist() for c in Q._COLUMNS))) == [brute(t) for t in texts]


def test_very_long_text_and_empty_table(spark, documents_of):
    text = " ".join(str(i) for i in range(300_000))
    got = run(documents_of([(1, text), (2, text[:1000] + " " + text[:1000])]))
    assert got[0][1] == 300_000 and got[0][5] == 0 and got[0][7] and not got[1][7]
    assert run(documents_of([])) == []
