"""Secret spans of all given documents against a plain version that counts every window anew."""

import hashlib
import random
import re
import string
from collections import Counter
from math import log2

from sparkprep.llm import secret_scan
from tests.conftest import SF_MID

ENTROPY = secret_scan.Entropy()


def base(text):
    """Every position tried in turn, without the library's patterns."""
    out, at = [], 0
    names = ("password", "passwd", "secret", "token", "apikey", "api_key")
    value = set(string.ascii_letters + string.digits + "+/_.=-")
    low = "".join(c.lower() if c in string.ascii_uppercase else c for c in text)
    while at < len(text):
        name = next((n for n in names if low.startswith(n, at)), None) if low[at] in "psta" else None
        if name:
            k = at + len(name)
            k += k < len(text) and text[k] in "\"'"
            while text[k:k + 1] == " ":
                k += 1
            if text[k:k + 1] in (":", "="):
                k += 1
                while text[k:k + 1] == " ":
                    k += 1
                k += k < len(text) and text[k] in "\"'"
                end = k
                while end < len(text) and text[end] in value:
                    end += 1
                if end > k:
                    if end - k >= 6:
                        out.append(("assign", at, end))
                    at = end
                    continue
        at += 1
    for kind, chars, prefix, least in (("access", string.ascii_uppercase + string.digits, "AKIA", 20),
                                       ("hex", "0123456789abcdef", "", 24)):
        at = 0
        while at < len(text):
            end = at + len(prefix)
            if text.startswith(prefix, at):
                while end < len(text) and text[end] in chars:
                    end += 1
            if end > at + len(prefix):
                if end - at >= least:
                    out.append((kind, at, end))
                at = end
            else:
                at += 1
    return out


def entropy(text):
    """Every window of every class whose characters are all in the class and not allowed."""
    free = [True] * len(text)
    every = {c for k in ENTROPY.classes for c in expanded(k.chars)}
    least = min(k.width for k in ENTROPY.classes)
    run = []
    for i, c in enumerate(text + " "):
        if c in every:
            run.append(i)
            continue
        if len(run) < least:
            for j in run:
                free[j] = False
        else:
            for p in ENTROPY.allowed:
                for m in re.compile(p).finditer(text, run[0], run[-1] + 1):
                    free[m.start():m.end()] = [False] * (m.end() - m.start())
        run = []
    marked = set()
    for k in ENTROPY.classes:
        chars = expanded(k.chars)
        for a in range(len(text) - k.width + 1):
            if text[a + k.width - 1] not in chars or text[a + k.width // 2] not in chars:
                continue
            window = text[a:a + k.width]
            if not (set(window) <= chars and all(free[a:a + k.width])):
                continue
            bits = -sum(n / k.width * log2(n / k.width) for n in Counter(window).values())
            odd = sum(secret_scan.odd_pair(x, y) for x, y in zip(window, window[1:]))
            if bits >= k.bits - 1e-9 and odd >= k.odd:
                marked.add((a, a + k.width))
    spans = []
    for a, b in sorted(marked):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    return [("entropy", a, b) for a, b in spans]


def expanded(chars):
    return {chr(c) for c in range(33, 127) if re.fullmatch(f"[{chars}]", chr(c))}


def wanted(text):
    kinds = ("assign", "access", "hex", "entropy")
    return sorted(base(text) + entropy(text), key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def test_all_given_documents(spark):  # the smallest tables hold no secrets
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = {r["doc_id"]: r for r in secret_scan.digests(secret_scan.scanned(docs)).collect()}
    assert set(rows) == set(texts)
    found = 0
    for i, text in texts.items():
        spans = wanted(text)
        found += len(spans)
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in spans if k != "entropy")
        count = Counter(k for k, *_ in spans)
        assert rows[i]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans), i
        assert (rows[i]["n_assign"], rows[i]["n_access"], rows[i]["n_hex"]) == (
            count["assign"], count["access"], count["hex"])
        assert rows[i]["base_sha256"] == hashlib.sha256(digest.encode()).hexdigest()
    assert found


def test_random_texts():
    draw, scanner = random.Random(5), secret_scan.Scanner()
    pieces = ["token", "TOKEN: ", "api_key=", 'Password"  =  \'', "secret:", "apikey", "AKIA", "xxxx", "example", " ", "\n",
              "2024-01-01", "550e8400-e29b-41d4-a716-446655440000", "é", "the", "-", "/", "_", "=", "K"]
    sets = ("0123456789abcdef", string.ascii_lowercase + string.digits, string.ascii_letters, "ABCDEF0123456789", "ab")
    for _ in range(400):
        text = "".join(draw.choice(pieces) if draw.random() < 0.6 else
                       "".join(draw.choices(draw.choice(sets), k=draw.choice((1, 6, 16, 20, 24, 40))))
                       for _ in range(draw.randint(1, 14)))
        assert scanner.spans(text) == wanted(text), text


def test_empty_tables_and_other_columns(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, "token = abcdef1", "b"), (None, "", "c")],
                                 "id long, text string, spans string")
    got = sorted((str(r["id"]), r["n_assign"], r["spans"]) for r in
                 secret_scan.digests(secret_scan.scanned(rows, "id"), "id").collect())
    assert got == [("1", 0, ""), ("1", 1, "assign:0:15"), ("None", 0, "")]
    assert secret_scan.digests(secret_scan.scanned(rows.where("id > 5"), "id"), "id").count() == 0
