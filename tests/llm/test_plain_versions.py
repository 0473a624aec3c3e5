"""Operators against plain versions of the same rules, written again from their definitions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from armlens.llm import language_id, secrets, toxicity


def plain_ftrl(rows, n_features, n_classes, epochs, alpha, l1, l2):
    """One coordinate and class at a time; the last feature is the bias, which isn't penalised."""
    z = [[0.0] * n_classes for _ in range(n_features + 1)]
    n = [[0.0] * n_classes for _ in range(n_features + 1)]

    def weight(i, c):
        if i == n_features:
            return -z[i][c] / ((1 + math.sqrt(n[i][c])) / alpha)
        if abs(z[i][c]) <= l1:
            return 0.0
        return -(z[i][c] - math.copysign(l1, z[i][c])) / ((1 + math.sqrt(n[i][c])) / alpha + l2)

    for _ in range(epochs):
        for at, value, label in rows:
            some = [*zip(at.tolist(), value.tolist(), strict=True), (n_features, 1.0)]
            w = {(i, c): weight(i, c) for i, _ in some for c in range(n_classes)}
            score = [sum(v * w[i, c] for i, v in some) for c in range(n_classes)]
            total = sum(math.exp(s - max(score)) for s in score)
            for c in range(n_classes):
                p = math.exp(score[c] - max(score)) / total - (c == label)
                for i, v in some:
                    g = v * p
                    sigma = (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / alpha
                    z[i][c] += g - sigma * w[i, c]
                    n[i][c] += g * g
    return [[weight(i, c) for c in range(n_classes)] for i in range(n_features)], [weight(n_features, c) for c in range(n_classes)]


def test_language_training_is_ftrl():
    rng = np.random.default_rng(0)
    rows = []
    for k in range(60):
        at = np.sort(rng.choice(12, rng.integers(1, 6), replace=False))
        rows.append((at, rng.random(len(at)), k % 3))
    w, b = language_id._ftrl(rows, 12, 3, 3, 0.5, 0.05, 0.01)
    want, bias = plain_ftrl(rows, 12, 3, 3, 0.5, 0.05, 0.01)
    assert np.allclose(w, want, atol=1e-10) and np.allclose(b, bias, atol=1e-10) and (np.array(want) == 0).any()


def test_calibration_has_the_least_loss():
    rng = np.random.default_rng(1)
    logits, label = rng.normal(size=(300, 4)) * 5, rng.integers(0, 4, 300)
    logits[np.arange(300), label] += 3

    def loss(t):
        return float(np.mean([math.log(sum(math.exp(v / t) for v in z)) - z[y] / t for z, y in zip(logits, label, strict=True)]))

    t = language_id._calibrate(logits, label)
    assert all(loss(t) <= loss(t * f) + 1e-12 for f in (0.5, 0.9, 0.99, 1.01, 1.1, 2.0))


def test_toxicity_of_two_grades_is_weighted_logistic_regression():
    """With one threshold: Newton's method on the features that are used gives the same weights."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(400):
        toxic = k % 4 == 0
        at = [i for i in range(10) if rng.random() < (0.6 if toxic and i < 4 else 0.04)] + [10 + k]
        rows.append((np.array(at), rng.random(len(at)) + 0.5, int(toxic)))
    w, theta = toxicity._train(rows, 500, 1, 6000, 0.02, 1e-3, 3.5)
    used = w.nonzero()[0]
    assert 0 < len(used) <= 10 and len(theta) == 1
    x = np.zeros((400, len(used) + 1))
    for k, (at, value, _) in enumerate(rows):
        for i, v in zip(at, value, strict=True):
            if i in used:
                x[k, np.searchsorted(used, i)] = v
    x[:, -1] = -1
    y = np.array([r[2] for r in rows], float)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    penalty = np.append(np.full(len(used), 1e-3), 0.0)
    b = np.zeros(len(used) + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ b))
        b = b - np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + np.diag(penalty + 1e-12), x.T @ (weight * (p - y)) + penalty * b)
    assert np.allclose(w[used], b[:-1], atol=0.02) and abs(theta[0] - b[-1]) < 0.02


NAMES = ["password", "passwd", "secret", "token", "apikey", "api_key"]
VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def plain_base(text):
    """(start, kind, end) of the three base kinds, by walking along the text."""
    found, i = [], 0
    while i < len(text):
        end = None
        for name in NAMES:
            if text[i : i + len(name)].lower() == name and text[i : i + len(name)].isascii():
                j = i + len(name)
                j += text[j : j + 1] in ("'", '"') and j < len(text)
                while text[j : j + 1] == " ":
                    j += 1
                if text[j : j + 1] not in (":", "="):
                    continue
                j += 1
                while text[j : j + 1] == " ":
                    j += 1
                if text[j : j + 1] in ("'", '"') and j < len(text):
                    j += 1
                start = j
                while j < len(text) and text[j] in VALUE:
                    j += 1
                if j > start:
                    end, size = j, j - start
                    break
        if end is None:
            i += 1
        else:
            if size >= 8:
                found.append((i, 0, end))
            i = end
    i = 0
    while (i := text.find("AKIA", i)) >= 0:
        j = i + 4
        while j < len(text) and (text[j].isdigit() and text[j].isascii() or "A" <= text[j] <= "Z"):
            j += 1
        if j - i >= 16:
            found.append((i, 1, j))
        i = j if j > i + 4 else i + 1
    i = 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] in "0123456789abcdef":
            j += 1
        if j - i >= 32:
            found.append((i, 2, j))
        i = max(j, i + 1)
    return sorted(found)


def pairwise(spans, reach):
    """Every weak span is held against every other of its scope."""
    partners = {3: (0, 2, 4), 4: (1, 3, 5), 5: (0, 2, 4)}
    out = []
    for i, (kind, a, b, scope) in enumerate(spans):
        near = any(s == scope and k in partners.get(kind, ()) and (a - y if j < i else x - b) <= reach for j, (k, x, y, s) in enumerate(spans) if j != i)
        if kind < 3 or near:
            out.append((a, kind, b))
    return out


def documents(rng, n):
    word = lambda letters, low, high: "".join(rng.choices(letters, k=rng.randrange(low, high)))
    mixed = "abcXYZ0189+/"
    made = [
        lambda: rng.choice(NAMES + ["Password", "API_KEY", "SECRET"]) + rng.choice(["=", ": ", '" : "', " = '", "'=", " "]) + word(mixed, 1, 20),
        lambda: "AKIA" + word("ABC019", 1, 22), lambda: word("0123456789abcdef", 20, 45), lambda: rng.choice(["user=", "login: ", "account_id="]) + word("abc_.9", 1, 9),
        lambda: word("abcXYZ0189", 15, 40), lambda: "https://" + word("abc./", 1, 12), lambda: "\n \n", lambda: "\n", lambda: word("xyz ", 1, 300), lambda: "é\U0001f600",
    ]
    return [rng.choice(["", " ", "; "]).join(rng.choice(made)() for _ in range(rng.randrange(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("reach", [0, 25, 400])
def test_secrets_are_the_plain_spans_linked_pair_by_pair(spark, reach):
    texts = documents(random.Random(reach), 400)
    out = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), reach=reach).collect()}
    linked = 0
    for i, text in enumerate(texts):
        got = [(s["start"], s["kind"], s["end"]) for s in out[i]["spans"]]
        assert [s for s in got if s[1] < 3] == plain_base(text), text
        assert got == pairwise(secrets.find_spans(text), reach), text
        linked += any(s[1] >= 3 for s in got)
        assert [out[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[1] == k for s in got) for k in range(3)]
    assert linked > (5 if reach == 0 else 50)
