"""Small documents with the awkward cases: nulls, empty texts, copies, ties, long texts, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, fp long"


def documents(seed: int = 7, n: int = 120) -> list[tuple]:
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    shared = " ".join(rng.choice(words) for _ in range(60))
    lines = [" ".join(rng.choice(words) for _ in range(6)) for _ in range(8)]
    texts: list[str | None] = [None, "", " ", "\n", "one", "one two", shared, "a\t\x0b b", "é ü 日本語 ß", "\n\nx\n"]
    while len(texts) < n:
        t = " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(rng.choice([3, 30, 90, 300])))
        kind = rng.random()
        if kind < 0.2:
            t = f"{t} {shared} {t[:40]}"
        elif kind < 0.4:
            t = "\n".join([t, rng.choice(lines), "  " + rng.choice(lines).upper() + "\r", t[:30]])
        elif kind < 0.55 and texts[-1]:
            t = texts[rng.randrange(6, len(texts))] or ""
        elif kind < 0.65:
            old = (texts[rng.randrange(6, len(texts))] or "").split(" ")
            old[rng.randrange(len(old))] = "changed"
            t = " ".join(old)
        elif kind < 0.75:
            secret = rng.choice(["password = 'abc'", "token: abcdef12", "API_KEY=\"zzzzzzzz\"", "AKIA" + "Q7" * 9, "AKIASHORT", "deadbeef" * 4, "secret=token=abcdef", "token=token: abcdefg", "-----BEGIN RSA PRIVATE KEY-----"])
            t = f"{t[:50]} é {secret}\n{secret} {t[50:]}"
        texts.append(t)
    texts.append(" ".join(rng.choice(words) for _ in range(20_000)))
    out = [(i * 3, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s1", None]), None, "x", "y", 1) for i, t in enumerate(texts)]
    rng.shuffle(out)
    return out
