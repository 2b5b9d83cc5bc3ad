"""Personal information inside addresses, found by a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import ast
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sthalam.llm.pii_labels import KINDS, labelled_rows
from sthalam.session import shared_folder

#: Rows of the labelled table that the model is trained on, and passes over them.
TRAIN_ROWS, EPOCHS = 4000, 7
#: A name begins only where it is e to this power times likelier than all else: names without a cue are told by their spelling alone.
CAUTION = 1.0
#: Words of the labelled table in which a feature must occur to have weights.
LEAST = 4
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
OFFSETS = (-2, -1, 0, 1, 2)
#: Words whose scores a worker keeps; beyond it the store is emptied.
KEPT_WORDS = 300_000
#: Words that may begin a further address (fixed values); whether one stands before a word is a feature of the word's place.
CUES = {"NATIVE", "ALSO", "OLD", "OFFICE:", "OFFICE", "WORKS", "R/O", "PERM", "PERMANENT", "PREV", "PREVIOUS", "RES"}
#: Titles before a person's name (fixed values).
TITLES = {"MR", "MRS", "MS", "SHRI", "SMT", "KUM", "DR", "LATE", "PROF", "ADV"}
NOT_AFTER = {"POST", "NEAR", "NR", "OPP", "BEHIND"}
_DIGITS = re.compile(r"\D?\d+\D?")
_NINES = str.maketrans("0123456789", "9" * 10)


def word_key(word: str) -> str:
    """What tells words with the same features: capitals, and figures as nines but for the first two of a long number."""
    w = word.upper()
    n = w.translate(_NINES)
    if n == w and "9" not in w:
        return w
    if n.count("9") < 10:
        return n
    i = n.index("9")
    return n[:i] + w[i : i + 3] + n[i + 3 :]


def shape(word: str) -> str:
    """Letters as A, runs of figures by their length, the rest as it is."""
    x = re.sub(r"\d+", lambda m: f"9{min(len(m[0]), 13)}.", re.sub(r"[A-Z]+", "A", word))
    return x[:24]


def word_features(word: str) -> list[str]:
    """What the model sees of one word, wherever it stands."""
    w = re.sub(r"#{2,}", "", word.upper()) or "#"
    s = shape(w)
    out = [f"w={w}" if not any(c.isdigit() for c in w) else "w=9", f"s={s}"]
    if "@" in w or "(AT)" in w or "[AT]" in w:
        out.append("at" if len(w) > 5 else "at-sign")
    if re.search(r"[A-Z]\.[A-Z]{2,}$", w):
        out.append("dot")
    bare = w.strip(".:")
    if bare in TITLES:
        out.append("title")
    elif re.fullmatch("[SWDH]/O", bare):
        out.append("of")
    if w.isalpha():
        out.append(f"n={min(len(w), 12)}")
        if len(w) > 3:
            out += [f"p2={w[:2]}", f"p3={w[:3]}", f"p4={w[:4]}", f"z2={w[-2:]}", f"z3={w[-3:]}", f"z4={w[-4:]}"]
    elif ":" in w or "-" in w:
        out.append(f"head={re.split('[:-]', w)[0][:8]}")
    digits = re.sub(r"\D", "", w)
    if len(digits) >= 10:
        out.append(f"d={min(len(digits), 14)},{digits[:2] == '91'},{w[:1]}")
    return out


class WordForm:
    """What the place features need to know of a word: whether it is a group of figures, of how many, and whether a further address may begin with it."""

    __slots__ = ("digits", "group", "cue", "bars")

    def __init__(self, word: str):
        up = word.upper()
        self.group = bool(_DIGITS.fullmatch(word))
        self.digits = sum(c.isdigit() for c in word)
        self.cue, self.bars = up in CUES, up in NOT_AFTER


def chain_features(forms: list[WordForm], gaps: list[bool]) -> tuple[list[tuple[int, str]], int]:
    """((place, name of the row of figure groups it belongs to) of each word in one, first place after which a further address goes on).

    With the separators beside a word and whether it is the first one, which need no names, these are what the model sees of a word's place.
    """
    n, runs, cue = len(forms), [], len(forms)
    i = 0
    while i < n:
        f = forms[i]
        if f.cue and cue == n and not (i and forms[i - 1].bars):
            cue = i
        if f.group and i + 1 < n and forms[i + 1].group and not gaps[i + 1]:
            j = i + 1
            while j < n and forms[j].group and not gaps[j]:
                j += 1
            text = "-".join(str(x.digits) for x in forms[i:j])[:16]
            runs += [(k, f"run={text},{k - i}") for k in range(i, j)]
            i = j
        else:
            i += 1
    return runs, cue


def place_features(words: list[str], gaps: list[bool]) -> list[list[str]]:
    """The names of each place's features, as the training sees them."""
    runs, cue = chain_features([WordForm(w) for w in words], gaps)
    n = len(words)
    out = [[f"gap={gaps[i]},{gaps[i + 1] if i + 1 < n else 'end'}", "first" if i == 0 else "mid", f"further={cue < i}"] for i in range(n)]
    for k, name in runs:
        out[k].append(name)
    return out


class _Gaps(dict):
    def __missing__(self, sep: str) -> bool:
        x = self[sep] = bool(re.search(r"[,;|]|  ", sep))
        return x


_WORDS, _GAPS = re.compile(r"([^\s,;|]+)"), _Gaps()


def split_words(text: str) -> tuple[list[str], list[str], list[bool]]:
    """(words and what separates them, words, whether a separator stands before each word)."""
    if len(_GAPS) > 100_000:
        _GAPS.clear()
    pieces = _WORDS.split(text)
    words = pieces[1::2]
    gaps = [_GAPS[x] for x in pieces[:-1:2]]
    if gaps:
        gaps[0] = True
    return pieces, words, gaps


def word_spans(pieces: list[str]) -> list[tuple[int, int]]:
    at, out = 0, []
    for k, x in enumerate(pieces):
        if k % 2:
            out.append((at, at + len(x)))
        at += len(x)
    return out


def _pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    out = np.full((len(rows), max(1, lengths.max(initial=0))), -1, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, lengths


class Crf:
    """Weights for each label of word features at five offsets and of place features, and for each pair of neighbouring labels."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.size = len(LABELS)

    # --- features as rows of indices
    def _ids(self, features: list[str], grow: bool) -> list[int]:
        if grow:
            return [self.index.setdefault(f, len(self.index)) for f in features]
        return [k for f in features if (k := self.index.get(f)) is not None]

    def train(self, rows: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = EPOCHS, seed: int = 7, rate: float = 0.06, decay: float = 2e-5) -> Crf:
        """Minimises the negative log-likelihood by Adam over batches of rows, with a small decay of the weights."""
        types: dict[str, int] = {}
        words_of, places_of, gold = [], [], []
        for text, spans in rows:
            pieces, words, gaps = split_words(text)
            if not words:
                continue
            at = word_spans(pieces)
            words_of.append(np.array([types.setdefault(word_key(w), len(types)) for w in words]))
            places_of.append(place_features(words, gaps))
            y = np.zeros(len(words), np.int64)
            for a, b, kind in spans:
                inside = [i for i, (s, e) in enumerate(at) if s < b and e > a]
                for n, i in enumerate(inside):
                    y[i] = 1 + 2 * KINDS.index(kind) + (n > 0)
            gold.append(y)
        features = [word_features(w) for w in types]
        often = np.bincount(np.concatenate(words_of), minlength=len(types))
        seen: dict[str, int] = {}
        for fs, n in zip(features, often.tolist(), strict=True):
            for f in fs:
                seen[f] = seen.get(f, 0) + n
        word_rows = [self._ids([f for f in fs if seen[f] >= LEAST], True) for fs in features]
        place_index: dict[str, int] = {}
        place_rows = [[[place_index.setdefault(f, len(place_index)) for f in x] for x in p] for p in places_of]
        self.places = place_index
        shape_w, n_l = (len(OFFSETS), len(self.index), self.size), self.size
        params = [np.zeros(s, np.float32) for s in (shape_w, (len(place_index), n_l), (n_l, n_l), (n_l,))]
        m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        rng, step, batch = np.random.default_rng(seed), 0, 48
        for _ in range(epochs):
            order = rng.permutation(len(words_of))
            for k in range(0, len(order), batch):
                part = order[k : k + batch]
                step += 1
                grads = self._gradient(params, [words_of[i] for i in part], [place_rows[i] for i in part], [gold[i] for i in part], word_rows)
                eta = rate / (1 + 0.01 * step)
                for p, g, a, b in zip(params, grads, m1, m2, strict=True):
                    g = (g / len(part)).astype(np.float32) + np.float32(decay) * p
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    p -= eta * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        self.w, self.v, self.t, self.start = (p.astype(np.float32) for p in params)
        name = LABELS.index("B-person")
        self.start[name] -= CAUTION
        self.t[:, name] -= CAUTION
        # a span begins by its B label: I follows only B or I of its own kind
        for k in range(2, self.size, 2):
            self.start[k] = -1e4
            bad = np.ones(self.size, bool)
            bad[[k - 1, k]] = False
            self.t[bad, k] = -1e4
        return self

    def _emissions(self, params, padded, lengths, place_flat, place_at, word_rows, need):
        """Scores of each label at each place of a padded batch, from the words in `need`."""
        flat = np.concatenate([np.array(word_rows[t]) for t in need]) if len(need) else np.zeros(0, int)
        owner = np.repeat(np.arange(len(need)), [len(word_rows[t]) for t in need])
        local = np.searchsorted(need, np.where(padded < 0, need[0], padded))
        b, t = padded.shape
        e = np.zeros((b, t, self.size))
        for o, d in enumerate(OFFSETS):
            v = _group_sums(params[0][o][flat], owner, len(need))
            lo, hi = max(0, -d), t - max(0, d)
            if hi > lo:
                ok = padded[:, lo + d : hi + d] >= 0
                e[:, lo:hi] += np.where(ok[:, :, None], v[local[:, lo + d : hi + d]], 0)
        np.add.at(e, (place_at[0], place_at[1]), params[1][place_flat])
        return e, flat, owner, local

    def _gradient(self, params, words, places, gold, word_rows):
        padded, lengths = _pad(words)
        y, _ = _pad(gold)
        b, t = padded.shape
        need = np.unique(np.concatenate(words))
        place_flat = np.array([f for p in places for x in p for f in x])
        rows = np.array([i for i, p in enumerate(places) for x in p for _ in x])
        cols = np.array([j for p in places for j, x in enumerate(p) for _ in x])
        e, flat, owner, local = self._emissions(params, padded, lengths, place_flat, (rows, cols), word_rows, need)
        trans, start = params[2], params[3]
        live = padded >= 0
        fw, bw = np.zeros((b, t, self.size)), np.zeros((b, t, self.size))
        fw[:, 0] = start + e[:, 0]
        for k in range(1, t):
            x = _lse(fw[:, k - 1, :, None] + trans) + e[:, k]
            fw[:, k] = np.where(live[:, k, None], x, fw[:, k - 1])
        z = _lse1(fw[:, -1])
        for k in range(t - 2, -1, -1):
            x = _lse((trans.T + (e[:, k + 1] + bw[:, k + 1])[:, :, None]))
            bw[:, k] = np.where(live[:, k + 1, None], x, 0)
        p = np.exp(np.minimum(0, fw + bw - z[:, None, None])) * live[:, :, None]
        diff = p.copy()
        bi, ti = np.nonzero(live)
        diff[bi, ti, y[bi, ti]] -= 1
        gt = np.zeros_like(trans)
        for k in range(1, t):
            on = live[:, k]
            if on.any():
                pair = np.exp(np.minimum(0, fw[on, k - 1, :, None] + trans + (e[on, k] + bw[on, k])[:, None, :] - z[on, None, None]))
                gt += pair.sum(0)
                np.add.at(gt, (y[on, k - 1], y[on, k]), -1)
        gw = np.zeros_like(params[0])
        order = np.argsort(flat, kind="stable")
        for o, d in enumerate(OFFSETS):
            lo, hi = max(0, -d), t - max(0, d)
            if hi <= lo:
                continue
            ok = (padded[:, lo + d : hi + d] >= 0) & live[:, lo:hi]
            g = np.zeros((len(need), self.size))
            np.add.at(g, local[:, lo + d : hi + d][ok], diff[:, lo:hi][ok])
            gw[o] = _group_sums(g[owner[order]], flat[order], gw.shape[1])
        gv = np.zeros_like(params[1])
        np.add.at(gv, place_flat, diff[rows, cols])
        return [gw, gv, gt, diff[:, 0].sum(0)]

    # --- decoding
    def word_scores(self, word: str) -> np.ndarray:
        """(offsets, labels): what the word adds to the labels of the words around it."""
        ids = self._ids(word_features(word), False)
        return self.w[:, ids].sum(axis=1) if ids else np.zeros((len(OFFSETS), self.size), np.float32)

    def _place(self, name: str) -> np.ndarray:
        n = self.places.get(name)
        return np.zeros(self.size, np.float32) if n is None else self.v[n]

    def decode(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """The spans (from, to, kind) of every text, by Viterbi over batches of texts of like length."""
        found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        split = [(i, *split_words(t)) for i, t in enumerate(texts) if t]
        split = sorted((x for x in split if x[2]), key=lambda x: len(x[2]))
        store = _STORE.setdefault(id(self), _Words(self))
        gap = np.stack([np.stack([self._place(f"gap={a},{b}") for b in (False, True, "end")]) for a in (False, True)])
        first, mid, before, after = (self._place(x) for x in ("first", "mid", "further=False", "further=True"))
        at = 0
        while at < len(split):
            most = len(split[min(at + 1023, len(split) - 1)][2])
            size = max(1, min(1024, 200_000 // most))  # very long texts are few to a batch
            part = split[at : at + size]
            at += size
            store.trim()
            b, t = len(part), len(part[-1][2])
            ids, gaps = np.full((b, t), -1, np.int64), np.full((b, t + 1), 2, np.int8)
            cues, runs = np.empty(b, np.int64), []
            for r, (_, _, words, g) in enumerate(part):
                n = len(words)
                known = [store[w] for w in words]
                ids[r, :n] = known
                gaps[r, :n] = g
                own, cues[r] = chain_features([store.forms[k] for k in known], g)
                runs += [(r, k, name) for k, name in own]
            table = store.table()
            live = ids >= 0
            e = gap[np.minimum(gaps[:, :t], 1), gaps[:, 1:]]
            e[:, 0] += first
            e[:, 1:] += mid
            e += np.where((np.arange(t)[None, :] > cues[:, None])[:, :, None], after, before)
            for o, d in enumerate(OFFSETS):
                lo, hi = max(0, -d), t - max(0, d)
                if hi > lo:
                    e[:, lo:hi] += table[ids[:, lo + d : hi + d], o]  # -1 is the last row, of zeros
            for r, k, name in runs:
                e[r, k] += self._place(name)
            path = self._viterbi(e, live)
            for r in np.flatnonzero((path > 0).any(axis=1)).tolist():
                i, pieces, words, _ = part[r]
                found[i] = _spans(path[r, : len(words)].tolist(), word_spans(pieces))
        return found

    def _viterbi(self, e: np.ndarray, live: np.ndarray) -> np.ndarray:
        b, t, n = e.shape
        back = np.zeros((t, b, n), np.int8)
        into = np.ascontiguousarray(self.t.T)  # (to, from)
        s = self.start + e[:, 0]
        rows = np.arange(b)[:, None]
        for k in range(1, t):
            x = s[:, None, :] + into
            best = x.argmax(axis=2)
            top = np.take_along_axis(x, best[:, :, None], 2)[:, :, 0] + e[:, k]
            on = live[:, k, None]
            back[k] = np.where(on, best, np.arange(n))
            s = np.where(on, top, s)
        path = np.zeros((b, t), np.int64)
        path[:, -1] = s.argmax(axis=1)
        for k in range(t - 1, 0, -1):
            path[:, k - 1] = back[k][rows[:, 0], path[:, k]]
        return np.where(live, path, 0)

    # --- keeping
    def parts(self) -> list[tuple[str, bytearray]]:
        """The model as named blocks of bytes."""
        arrays = {"w": self.w, "v": self.v, "t": self.t, "start": self.start}
        names = {"index": "\n".join(self.index), "places": "\n".join(self.places), "shapes": repr({k: a.shape for k, a in arrays.items()})}
        return [(k, bytearray(a.tobytes())) for k, a in arrays.items()] + [(k, bytearray(x.encode())) for k, x in names.items()]

    @classmethod
    def of_parts(cls, parts: dict[str, bytes]) -> Crf:
        m = cls()
        shapes = ast.literal_eval(parts["shapes"].decode())
        for k, shape in shapes.items():
            setattr(m, k, np.frombuffer(parts[k], np.float32).reshape(shape).copy())
        m.index, m.places = ({x: i for i, x in enumerate(parts[k].decode().split("\n"))} for k in ("index", "places"))
        return m


class _Words(dict):
    """The number of each spelling and the scores and form of each number; emptied beyond KEPT_WORDS."""

    def __init__(self, crf: Crf):
        super().__init__()
        self.crf, self.keys, self.forms = crf, {}, []
        self.scores = np.zeros((1024, len(OFFSETS), crf.size), np.float32)

    def __missing__(self, word: str) -> int:
        key = word_key(word)
        n = self.keys.get(key)
        if n is None:
            n = self.keys[key] = len(self.forms)
            self.forms.append(WordForm(word))
            if n + 1 >= len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[n] = self.crf.word_scores(key)
        self[word] = n
        return n

    def table(self) -> np.ndarray:
        self.scores[-1] = 0
        return self.scores

    def trim(self) -> None:
        if len(self) > KEPT_WORDS:
            self.clear()
            self.keys, self.forms = {}, []


_STORE: dict[int, _Words] = {}


def _group_sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each group; `groups` is sorted."""
    out = np.zeros((n, values.shape[1]))
    if len(groups):
        starts = np.flatnonzero(np.concatenate([[True], np.diff(groups) > 0]))
        out[groups[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


def _lse(x: np.ndarray) -> np.ndarray:
    m = x.max(axis=1)
    return m + np.log(np.exp(x - m[:, None]).sum(axis=1))


def _lse1(x: np.ndarray) -> np.ndarray:
    m = x.max(axis=1)
    return m + np.log(np.exp(x - m[:, None]).sum(axis=1))


def _spans(path: list[int], at: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    out: list[list] = []
    last = None
    for label, (a, b) in zip(path, at, strict=True):
        kind = KINDS[(label - 1) // 2] if label else None
        if kind is None:
            last = None
        elif kind == last and label % 2 == 0:
            out[-1][1] = b
        else:
            out.append([a, b, kind])
            last = kind
    return [tuple(x) for x in out]


@functools.cache
def model(rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> Crf:
    """The model for the labelled table of so many rows, trained once in a process."""
    return Crf().train(labelled_rows(rows), epochs)


def kept_model(spark: SparkSession, rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> Crf:
    """The model, trained once: its weights are a small table in the shared folder, which later sessions read.

    The table's name tells the labelled table and the settings, so changed ones are trained anew.
    """
    mark = hashlib.md5(repr((labelled_rows(200), rows, epochs, LEAST, CAUTION, LABELS, OFFSETS, word_features("S/O."), word_features("RAMESH"))).encode()).hexdigest()
    at = f"{shared_folder(spark)}/crf-{mark}"
    try:
        return Crf.of_parts({r["name"]: bytes(r["data"]) for r in spark.read.parquet(at).collect()})
    except AnalysisException:  # no such table
        m = model(rows, epochs)
        spark.createDataFrame(m.parts(), "name string, data binary").coalesce(1).write.mode("overwrite").parquet(at)
        return m


def _holds(text: str, kind: str) -> bool:
    """Whether a span can be what the model takes it for."""
    figures = sum(c.isdigit() for c in text)
    if kind == "email":
        return bool(re.search(r"@|\(at\)|\[at\]", text, re.I))
    if kind == "phone":
        return figures >= 10
    if kind == "identity":
        return figures >= 4
    if kind == "person":
        return not figures and any(c.isalpha() for c in text)
    return len(text) > 8


def personal_spans(rows: DataFrame, *, key: str = "row_id", text: str = "address", crf: Crf | None = None, redact: bool = False) -> DataFrame:
    """(`key`, kind, start, length, value) of every span found, or with `redact` (`key`, `text`, kinds): each row with its spans
    replaced by [PERSON], [EMAIL], [PHONE], [IDENTITY] or [ADDRESS] and the rest letter for letter as it was.

    A null or empty text has no spans and stays as it is; a null key and repeated rows are kept; other columns aren't read; texts
    are read whole. Only the trained weights are sent to the workers; there is no shuffle.
    """
    crf = crf or kept_model(rows.sparkSession)
    kind = rows.schema[key].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(crf)  # a few megabytes, whatever the number of rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for t in batches:
            texts = [x if isinstance(x, str) else None for x in t["x"]]
            keys, out = t["k"].tolist(), []
            for k, x, spans in zip(keys, texts, m.decode(texts), strict=True):
                k = None if k != k else k
                spans = [s for s in spans if _holds(x[s[0] : s[1]], s[2])]
                if redact:
                    clean, at = "", 0
                    for a, b, what in spans:
                        clean += x[at:a] + f"[{what.upper()}]"
                        at = b
                    out.append((k, None if x is None else clean + x[at:], sorted({s[2] for s in spans})))
                else:
                    out += [(k, what, a, b - a, x[a:b]) for a, b, what in spans]
            made = pd.DataFrame(out, columns=[key, text, "kinds"] if redact else [key, "kind", "start", "length", "value"], dtype=object)
            yield made

    schema = f"`{key}` {kind}, " + (f"`{text}` string, kinds array<string>" if redact else "kind string, start int, length int, value string")
    return rows.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("x")).mapInPandas(run, schema)
