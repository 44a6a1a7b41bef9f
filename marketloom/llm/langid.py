"""Language identification with error-correcting output codes.

Every language has a codeword; one binary classifier for each bit (logistic
regression on hashed byte n-grams of the whole text) predicts that bit, and
loss-weighted decoding picks the codeword with the least weighted logistic loss.
A bit weighs for a language what its classifier achieved on that language's
training texts.  A text whose two nearest codewords are about equally near is
flagged as ambiguous.

Up to seven languages get the exhaustive code (every split of the languages is a
bit), more get a fixed pseudo-random code of 8 bits per doubling.

The classifiers are fitted on the driver on a bounded sample: about ``sample``
texts of each language, chosen by a hash of id and text over all labelled rows.
Everything else covers all rows and whole texts.

Nulls: a null text, or one without a letter, is "und" with score 0; null labels
and null ids are never learned from.  Without labelled rows every text is "und";
with one language every text with letters gets it.  Ties go to the language first in
order.  Repeated rows are judged alike; only the named columns are read, so
extra columns of any name do no harm."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.common import map_texts, text_bytes

UNKNOWN = "und"
SAMPLE = 400
BUCKETS = 4096

_ASCII_LETTER = re.compile(rb"[A-Za-z]")
#: ASCII letters lower-cased, other ASCII a space; other bytes stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_MIX = np.uint32(2654435761)
_SHIFT = np.uint32(32 - (BUCKETS.bit_length() - 1))


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or any(
        c.isalpha() for c in text.decode("utf-8", "replace")
    )


def profile(text: bytes) -> np.ndarray:
    """Unit vector of the roots of hashed bigram and trigram counts."""
    b = np.frombuffer(b" ".join(text.translate(_FOLD).split()), dtype=np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS)
    if len(b) >= 2:
        two = (b[:-1] << np.uint32(8)) | b[1:]
        three = (two[:-1] << np.uint32(8)) | b[2:]
        for grams, salt in ((two, 1), (three, 2)):
            hashed = ((grams + np.uint32(salt * 0x5BD1E995)) * _MIX) >> _SHIFT
            counts += np.bincount(hashed, minlength=BUCKETS)
    root = np.sqrt(counts)
    norm = np.linalg.norm(root)
    return (root / norm if norm else root).astype(np.float32)


def codewords(classes: int) -> np.ndarray:
    """Rows of +1 and -1, one for each class."""
    if classes < 2:
        return np.ones((classes, 0))
    if classes <= 7:
        splits = range(1, 1 << (classes - 1))
        return np.array(
            [[1 if c == classes - 1 or not s >> c & 1 else -1 for s in splits] for c in range(classes)]
        )
    bits = 8 * (classes - 1).bit_length()
    draw = np.random.default_rng(1995)
    columns: list[np.ndarray] = []
    while len(columns) < bits:
        column = np.where(draw.permutation(classes) < classes // 2, 1, -1)
        if not any(abs(column @ other) == classes for other in columns):
            columns.append(column)
    return np.array(columns).T


@dataclass
class Decoder:
    languages: list[str]
    code: np.ndarray  # language x bit
    coefficients: np.ndarray  # bucket x bit
    intercepts: np.ndarray
    weights: np.ndarray  # language x bit

    def losses(self, profiles: np.ndarray) -> np.ndarray:
        """text x language: weighted logistic loss of the language's codeword."""
        margin = profiles @ self.coefficients + self.intercepts
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None, :, :])
        return (loss * self.weights[None, :, :]).sum(axis=2)

    def decode(self, profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score in 0..1, and the lead over the second best."""
        if len(self.languages) == 1:
            one = np.ones(len(profiles))
            return np.zeros(len(profiles), dtype=int), one, one
        losses = self.losses(profiles) * len(self.languages)
        shifted = np.exp(losses.min(axis=1, keepdims=True) - losses)
        share = shifted / shifted.sum(axis=1, keepdims=True)
        two = np.sort(share, axis=1)[:, -2:]
        return losses.argmin(axis=1), two[:, 1], two[:, 1] - two[:, 0]


def fit(profiles: np.ndarray, labels: list[str], steps: int = 120, decay: float = 1e-4) -> Decoder:
    """Fit one classifier for each bit; every language counts alike."""
    languages = sorted(set(labels))
    code = codewords(len(languages)).astype(np.float64)
    y = np.array([languages.index(x) for x in labels])
    target = code[y]
    share = 1.0 / np.bincount(y, minlength=max(1, len(languages)))[y] / max(1, len(languages))
    w = np.zeros((BUCKETS, code.shape[1]))
    b = np.zeros(code.shape[1])
    fast_w, fast_b = w, b
    x = profiles.astype(np.float64)
    for step in range(steps):  # accelerated gradient descent; profiles have norm 1
        z = x @ fast_w + fast_b
        g = -target / (1 + np.exp(np.clip(target * z, -50, 50))) * share[:, None]
        new_w = fast_w - 8.0 * (x.T @ g + decay * fast_w)
        new_b = fast_b - 1.0 * g.sum(axis=0)
        momentum = step / (step + 3)
        fast_w, w = new_w + momentum * (new_w - w), new_w
        fast_b, b = new_b + momentum * (new_b - b), new_b
    right = (np.sign(x @ w + b) == target).astype(np.float64)
    weights = np.array([right[y == c].mean(axis=0) for c in range(len(languages))])
    if len(languages) > 1:
        weights = weights / weights.sum(axis=1, keepdims=True)
    return Decoder(languages, code, w, b, weights)


def learn(
    docs: DataFrame, may_learn: Column, sample: int = SAMPLE, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> Decoder | None:
    """Fit on about ``sample`` rows of each label for which ``may_learn`` holds."""
    labelled = docs.filter(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = labelled.groupBy(lang_col).count().collect()  # one row for each language
    if not sizes:
        return None
    scale = 1 << 30
    draw = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(scale))
    chosen = F.lit(False)
    for lang, n in sizes:
        chosen = chosen | ((F.col(lang_col) == lang) & (draw < min(scale, sample * scale // n)))
    result = T.StructType([T.StructField("profile", T.BinaryType())])

    def compute(texts):
        return [(profile(t).tobytes() if has_letter(t) else None,) for t in texts]

    rows = (
        map_texts(labelled.filter(chosen), [lang_col, id_col], text_bytes(text_col), result, compute)
        .select(F.col("row").getField(lang_col).alias("lang"), "out.profile")
        .filter("profile is not null")
        .collect()
    )
    rows = sorted((r["lang"], bytes(r["profile"])) for r in rows)
    if not rows:
        return None
    x = np.array([np.frombuffer(p, dtype=np.float32) for _, p in rows])
    return fit(x, [lang for lang, _ in rows])


RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ambiguous", T.BooleanType()),
])


def predict_rows(
    docs: DataFrame, decoder: Decoder | None, carry: list, text_col: str = "text", lead: float = 0.05,
) -> DataFrame:
    """``row`` (the carried columns) and ``out`` (RESULT) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(decoder)

    def compute(texts):
        d = shared.value
        out: list[tuple] = [(UNKNOWN, 0.0, False)] * len(texts)
        for at in range(0, len(texts), 512):
            known = [i for i in range(at, min(at + 512, len(texts))) if d and has_letter(texts[i])]
            if known:
                best, score, ahead = d.decode(np.array([profile(texts[i]) for i in known]))
                for i, b, s, a in zip(known, best, score, ahead):
                    out[i] = (d.languages[b], float(s), bool(a < lead))
        return out

    return map_texts(docs, carry, text_bytes(text_col), RESULT, compute)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """id, held_out, lang_pred, score, ambiguous of every row.  A third of the
    documents, by the CRC-32 of the id, is held out of the fit."""
    held_out = held(id_col)
    decoder = learn(docs, ~held_out & F.col(id_col).isNotNull(), sample, id_col, text_col, lang_col)
    found = predict_rows(docs, decoder, [F.col(id_col).alias("id"), held_out.alias("held_out")], text_col)
    return found.select(F.col("row.id").alias(id_col), "row.held_out", "out.*")


def held(id_col: str) -> Column:
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def keep_known(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is clear: neither "und"
    nor ambiguous.  A null language is filled with the predicted one."""
    learnable = ~held(id_col) & F.col(id_col).isNotNull()
    decoder = learn(docs, learnable, sample, id_col, text_col, lang_col)
    found = predict_rows(docs, decoder, docs.columns, text_col)
    clear = found.filter((F.col("out.lang_pred") != UNKNOWN) & ~F.col("out.ambiguous"))
    return clear.select([
        (F.coalesce(F.col("row").getField(c), "out.lang_pred") if c == lang_col
         else F.col("row").getField(c)).alias(c)
        for c in docs.columns
    ])
