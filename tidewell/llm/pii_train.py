"""Trains the trees of pii.py on generated texts and writes models/pii_trees.json.

    python -m tidewell.llm.pii_train

The texts hold personal data and look-alikes (versions, order numbers, prices, times, hashes, article numbers) among
invented words, with and without context words. Proposals and features come from pii.candidates itself, so training
and use see the same. A third of the texts is kept for the calibration and another third for the thresholds, which
are the least with a precision of PRECISION there.
"""

from __future__ import annotations

import json
import os
import random

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewell.llm.pii import FEATURES, KINDS, candidates

TEXTS, TREES, DEPTH, RATE, LEAST, PRECISION = 9000, 36, 3, 0.25, 12, 0.98


def _check_digit(digits: str) -> str:
    total = sum(v if i % 2 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(digits))))
    return digits + str(-total % 10)


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _word(r: random.Random) -> str:
    return "".join(r.choice(["an", "er", "st", "le", "on", "mi", "ta", "ou", "sch", "re", "ion", "qu", "el"]) for _ in range(r.randint(1, 4)))


def _grouped(digits: str, sep: str) -> str:
    return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def sample(r: random.Random) -> tuple[str, list[tuple[str, str]]]:
    """A text and its personal data as (kind, text)."""
    say = lambda *x: r.choice(x)
    out, real = [], []
    for _ in range(r.randint(1, 4)):
        out.append(" ".join(_word(r) for _ in range(r.randint(2, 12))))
        what, tld = r.randrange(19), say("com", "org", "net", "de", "fr", "io", "edu")
        name, host = say(_word(r), f"{_word(r)}.{_word(r)}", f"{_word(r)}{_digits(r, 2)}"), _word(r)
        if what in (0, 1):
            x = say(f"{name} (at) {host} (dot) {tld}", f"{name}[at]{host}[dot]{tld}", f"{name} at {host} dot {tld}", f"{name} @ {host}.{tld}", f"{name}(at){host}.{tld}", f"{name} at {host}.{tld}")
            out.append(say("", "mail", "contact:", "write to") + " " + x)
            real.append(("email", x))
        elif what == 2:
            x = ":".join("%x" % r.randrange(65536) for _ in range(8))
            out.append(say("", "host", "ip", "server") + " " + x)
            real.append(("ip", x))
        elif what == 17:
            left = ["%x" % (r.choice([0x2001, 0x2A02, 0xFE80, 0xFD00, 0x2600]) + r.randrange(4)), *("%x" % r.choice([r.randrange(65536), r.randrange(16)]) for _ in range(r.randint(0, 3)))]
            right = ["%x" % r.choice([r.randrange(65536), r.randrange(16)]) for _ in range(r.randint(1, 4))]
            x = ":".join(left) + "::" + ":".join(right)
            out.append(say("", "host", "ip", "server", "ping") + " " + x)
            real.append(("ip", x))
        elif what in (3, 4):
            x = _check_digit(say("34", "37") + _digits(r, 12)) if r.random() < 0.4 else _check_digit("4" + _digits(r, 14)) if r.random() < 0.8 else _check_digit("4" + _digits(r, 11))
            x = _grouped(x, say(".", " - ", "/", "_")) if len(x) == 16 else x
            out.append(say("card", "visa", "credit card no", "payment", "") + " " + x)
            real.append(("card", x))
        elif what in (5, 6):
            x = say(f"({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}", f"{_digits(r, 3)}-{_digits(r, 3)}-{_digits(r, 4)}", f"{_digits(r, 3)}.{_digits(r, 3)}.{_digits(r, 4)}", f"0{_digits(r, 3)} {_digits(r, 3)} {_digits(r, 4)}", f"00{_digits(r, 2)} {_digits(r, 3)} {_digits(r, 4)}")
            out.append(say("phone", "tel.", "call", "fax", "mobile:") + " " + x)
            real.append(("phone", x))
        else:
            out.append(
                say(
                    f"{_word(r)} at {_word(r)} dot {_word(r)}",
                    f"{_word(r)} at {_word(r)}.{_word(r).title()}",
                    f"{_word(r)} @ {_word(r)}.{_word(r)}",
                    f"price @ {_digits(r, 2)}.{_digits(r, 2)}",
                    f"{_digits(r, 2)}:{_digits(r, 2)}:{_digits(r, 2)}:{_digits(r, 2)}",
                    say("a::b", "::", f"{_digits(r, 1)}::{_digits(r, 1)}", f"{_digits(r, 2)}::{_digits(r, 2)}", "f::c", "::a", "d::", f"ab::{_digits(r, 1)}"),
                    ":".join("%02x" % r.randrange(256) for _ in range(6)),
                    f"order {_digits(r, 3)} {_digits(r, 3)} {_digits(r, 4)}",
                    f"{_digits(r, 16)}",
                    f"{_digits(r, 14)}",
                    f"id {_digits(r, 4)}-{_digits(r, 4)}-{_digits(r, 4)}-{_digits(r, 4)}",
                    f"serial {_digits(r, 15)}",
                    f"isbn {_digits(r, 3)}-{_digits(r, 3)}-{_digits(r, 4)}-{_digits(r, 2)}",
                    f"{_digits(r, 3)} {_digits(r, 3)} {_digits(r, 3)}",
                    f"{_digits(r, 3)}.{_digits(r, 3)}.{_digits(r, 3)}",
                    f"token = \"{_digits(r, 17)}ab\"",
                    f"2{_digits(r, 3)}-{_digits(r, 2)}-{_digits(r, 2)} 00{_digits(r, 2)} {_digits(r, 3)}",
                    f"version {_digits(r, 3)}.{_digits(r, 2)}.{_digits(r, 3)}",
                )
            )
        out.append(say("", "", ".", ",", " " + _word(r)))
    return " ".join(out), real


def _fit_tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A regression tree for gradients g and curvatures h, as nested [feature, limit, low, high] or a value."""
    if depth and len(g) >= 2 * LEAST:
        best, whole = (1e-3, None, None), g.sum() ** 2 / (h.sum() + 1)
        for j in range(x.shape[1]):
            order = np.argsort(x[:, j], kind="stable")
            v, gs, hs = x[order, j], np.cumsum(g[order]), np.cumsum(h[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            cut = cut[(cut + 1 >= LEAST) & (len(v) - cut - 1 >= LEAST)]
            if len(cut):
                gain = gs[cut] ** 2 / (hs[cut] + 1) + (gs[-1] - gs[cut]) ** 2 / (hs[-1] - hs[cut] + 1) - whole
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, float((v[cut[k]] + v[cut[k] + 1]) / 2))
        if best[1] is not None:
            low = x[:, best[1]] <= best[2]
            return [list(FEATURES)[best[1]], best[2], _fit_tree(x[low], g[low], h[low], depth - 1), _fit_tree(x[~low], g[~low], h[~low], depth - 1)]
    return round(float(RATE * g.sum() / (h.sum() + 1)), 5)


def apply_tree(node, x: np.ndarray) -> np.ndarray:
    if not isinstance(node, list):
        return np.full(len(x), node)
    low = x[:, list(FEATURES).index(node[0])] <= node[1]
    out = np.empty(len(x))
    out[low], out[~low] = apply_tree(node[2], x[low]), apply_tree(node[3], x[~low])
    return out


def train(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> dict:
    """Trees from part 0, a logistic step per kind from part 1, thresholds from part 2."""
    start = float(np.log((y[part == 0].mean() + 1e-6) / (1 - y[part == 0].mean() + 1e-6)))
    trees, margin = [], np.full(len(y), start)
    a = part == 0
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin[a]))
        trees.append(_fit_tree(x[a], y[a] - p, p * (1 - p), DEPTH))
        margin += apply_tree(trees[-1], x)
    model = {"start": round(start, 5), "trees": trees, "calibration": {}, "thresholds": {}}
    for k, kind in enumerate(KINDS):
        b = (part == 1) & (x[:, 0] == k)
        w = np.array([1.0, 0.0])
        d = np.stack([margin[b], np.ones(b.sum())], 1)
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + 1e-2 * np.eye(2), d.T @ (y[b] - p) - 1e-2 * (w - [1, 0]))
        model["calibration"][kind] = [round(float(v), 5) for v in w]
        c = (part == 2) & (x[:, 0] == k)
        p, order = 1 / (1 + np.exp(-(w[0] * margin[c] + w[1]))), None
        order = np.argsort(-p, kind="stable")
        right = np.cumsum(y[c][order]) / np.arange(1, c.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        model["thresholds"][kind] = round(max(0.5, float(p[order][good[-1]]) if len(good) else 0.99), 5)
        chosen = p >= model["thresholds"][kind]
        print(kind, "proposals", int(c.sum()), "real", int(y[c].sum()), "precision", round(float(y[c][chosen].mean()), 4) if chosen.any() else None, "recall", round(float(chosen[y[c] == 1].mean()), 4), "threshold", model["thresholds"][kind])
    return model


def training_rows(spark: SparkSession, texts: int = TEXTS, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = random.Random(seed)
    made = [(i, *sample(r)) for i in range(texts)]
    df = candidates(spark.createDataFrame([(i, t) for i, t, _ in made], "i long, text string"))
    rows = df.select("i", F.explode(F.expr(f"concat({', '.join(f'__more_{k}' for k in KINDS)})")).alias("c")).select("i", "c.m", "c.f.*").collect()
    real = {i: set(x) for i, _, x in made}
    x = np.array([[row[n] for n in FEATURES] for row in rows], float)
    y = np.array([float((KINDS[int(row["kind"])], row["m"]) in real[row["i"]]) for row in rows])
    return x, y, np.array([row["i"] % 3 for row in rows])


def main() -> None:
    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
    model = train(*training_rows(spark))
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "models", "pii_trees.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(model, f)
    spark.stop()


if __name__ == "__main__":
    main()
