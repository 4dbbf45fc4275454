"""Documents that cover the cases every operator must take, and plain helpers."""

import random
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, key int, ids string, score string, predicted string, "
          "tokens string, topic string, kept string, probability string, passages string, n string, component long, hub int, owner string")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(seed: int, n: int, size: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) + r.choice(["", "", "", ",", "."]) for _ in range(n))


def edited(text: str, seed: int, every: int) -> str:
    r = random.Random(seed)
    return " ".join(f"x{r.randint(0, 10**9)}" if r.randrange(every) == 0 else w for w in text.split(" "))


def texts() -> list[tuple]:
    """(doc_id, text): normal, near and exact copies, shared passages, null, empty, blank, very long, repeated rows, null ids."""
    base, other = prose(1, 300), prose(2, 200)
    passage = prose(3, 60)
    rows = [(10, base), (11, base), (12, edited(base, 5, 60)), (13, edited(base, 6, 60)), (14, other), (15, other + " tail"),
            (20, None), (21, ""), (22, " \t\n "), (23, "one two"), (24, "one two"), (25, "ONE  two"), (26, "123 !!"),
            (30, prose(4, 80) + " " + passage + " " + prose(5, 70)), (31, prose(6, 50) + "\n" + passage + " " + prose(7, 90)),
            (40, prose(8, 30_000)), (41, "é" * 3000 + " ñandú übermäßig 日本語 <|endoftext|> end"), (50, prose(9, 40)), (50, prose(9, 40)), (None, prose(10, 40)), (None, None)]
    return rows + [(100 + i, prose(100 + i, 30 + i)) for i in range(30)]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    lang = lambda i: None if i is None or i % 7 == 0 else ("en", "de")[i % 2]
    full = [(i, t, lang(i), None if i == 14 else f"s{(i or 0) % 3}", len(t or "")) + ("z", 3, "[1]", "s", "p", "t", "q", "k", "b", "c", "n", 7, 8, "o") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def word_list(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text, k: int) -> set:
    w = word_list(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
