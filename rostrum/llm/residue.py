"""Template residue, filler, error pages and script notices among documents.

Slots of a template that were never filled are found by their shapes.  The rest is
a positive-unlabelled problem: passages (lines) that match trusted error, filler
and notice patterns are positive, records of nothing but such passages are
positive records, all others are unlabelled.  A naive Bayes model over hashed words
is learned by expectation-maximization over all passages of the collection:

* a residue record holds residue passages only; a content record holds a residue
  passage (a notice beside the text) with a small probability, which is learned too;
* each round computes every record's posterior and every passage's weight, and
  counts words anew (numpy per task, then one small aggregation), until the number
  of residue records stands still;
* both classes are smoothed by the collection's own word distribution, so a word of
  content alone speaks against residue however rare it is, an unseen word does too,
  and the verdicts don't depend on the size of the collection.

A record is excluded if its posterior, prior included, is above one half.

Texts are parsed once, into hashed words of passages; rounds read those.

Defined results: NULL, empty and blank texts and texts of titles and navigation
alone are no cases; rows with equal ids are judged one by one; an empty table
gives no rows.  With no trusted passage in the table only slots are found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, ship
from .shingles import words_and_pieces

BUCKET_BITS = 16
SMOOTHING = 0.02  #: share of the collection's word distribution in that of each class
STEADY, ROUNDS = 1e-3, 30  #: rounds end when the sum of posteriors moves by less than this share, or at this number
SURE = 5.0  #: the most that one word, or a trusted passage, may say
FEATURES = 3  #: of a word: itself, its first and its last letters (bucket 0: none)
COMPANION = 25  #: words beside trusted passages up to which a record may be residue before anything is learned
SLICE, SLICE_BYTES = 1000, 1 << 22  #: texts and their bytes held as Python strings at a time

_WORDS = r"[A-Za-z][A-Za-z]*(?:[ _.-]?[A-Za-z]+){0,4}"
SLOT = re.compile(
    "|".join(
        [
            r"\{\{\s*[\w.]+\s*\}\}",
            r"\{(?!time\})(?:\d{1,2}|[a-z][A-Za-z]*(?:_[a-z]+)*)\}",
            r"\{%\s*[^%\n]+%\}",
            r"%\([A-Za-z_]\w*\)[sdf]",
            r"(?<![\w%])%[A-Z][A-Z_]{2,}%",
            r"(?<![\w%])%[sd](?!\w)",
            r"\$\{[^{}\n]+\}",
            r"\$+[A-Z][A-Z_]{2,}\$*(?!\w)",
            r"<%=?[^%\n]+%>",
            rf"<<\s*{_WORDS}\s*>>",
            r"<(?:[A-Z]+(?:[ _][A-Z]+)+|[A-Z]{4,})>",
            r"<(?:[a-z]+(?:[ _][a-z]+)+)>",
            r"\[\[(?!Page\b)\s*[A-Za-z]\w*(?:[ _]\w+)*\s*\]\]",
            r"\[(?:insert|INSERT|Insert)\b[^\[\]\n]+\]",
            rf"\[{_WORDS}\s+(?:to come|TBD|TK|TBA)\]",
            r"\[(?:TBD|TBA|TK)\]",
            r"\[[a-z]+(?: [a-z]+){0,3}\?\]",
            r"\((?:your|insert|enter)\s+[a-z]+(?: [a-z]+){0,3}\s+here\)",
            r"@@\w+@@",
            r"(?<![\w#])#[A-Z][A-Z_]{2,}#(?!\w)",
            r"(?<!\w)~[A-Z][A-Za-z]+~(?!\w)",
            r"«[A-Za-z][\w ]*»",
            r"(?<![\w/])X{2,4}/X{2,4}/X{2,4}(?![\w/])",
        ]
    )
)

#: What pages, files and records are called in messages.
_THING = r"(?:page|file|document|record|resource|item|link|article|site|content|entry|address|url|[a-z]+)"
#: The rest of a message: at most two more sentences.
_REST = r"[^.!?]*(?:[.!?]+[^.!?]*){0,2}$"
_SCRIPTS = r"(?:javascript|js|scripts?|script support|scripting|client-side scripting|cookies)\b"
#: Trusted residue: what servers, browsers and templates are known to print.
TRUSTED = re.compile(
    r"^\W*(?:"
    r"lorem ipsum\b"
    r"|(?:http )?(?:error )?[45]\d\d(?: -|:)? (?:not found|forbidden|internal server error|bad gateway|service unavailable|gateway time-?out|too many requests|bad request|unauthori[sz]ed)\b"
    + _REST
    + r"|(?:not found|forbidden|internal server error|bad gateway|service unavailable|gateway time-?out|too many requests|bad request|unauthori[sz]ed)\b(?: \(error \d+\)|:)"
    + _REST
    + r"|error:"
    + _REST
    + r"|\{\"(?:status|error|code)\":.*$"
    rf"|(?:sorry, )?(?:the|this|that) {_THING}(?: you (?:asked for|requested|are looking for|were looking for))? (?:could not be|was not|cannot be|can't be) (?:found|located)\b"
    + _REST
    + rf"|sorry, (?:the|this|that) {_THING} (?:is not here|is not available|does not exist|was not found)\b"
    + _REST
    + rf"|this {_THING} has been (?:moved|removed|deleted)\b"
    + _REST
    + r"|(?:we (?:are|were) )?unable to (?:process|complete|handle) your request\b"
    + _REST
    + rf"|you do not have (?:permission|access|the rights?) to (?:view|see|open|access) this {_THING}\b"
    + _REST
    + r"|your session (?:has )?(?:timed out|expired)\b"
    + _REST
    + r"|too many (?:calls|requests|attempts) (?:were|have been)\b"
    + _REST
    + r"|(?:our|the) (?:servers?|site|service) (?:is|are) (?:temporarily |currently )?(?:down|unavailable|offline)\b"
    + _REST
    + r"|the (?:upstream|remote) (?:host|server) (?:sent|gave|returned)\b"
    + _REST
    + rf"|(?:noscript: )?(?:{_SCRIPTS} and )?{_SCRIPTS} disabled\.?$"
    rf"|(?:please )?(?:enable|turn on|switch on|activate) {_SCRIPTS}"
    + _REST
    + rf"|(?:this|our|the) {_THING} (?:needs|requires) {_SCRIPTS}"
    + _REST
    + rf"|(?:we have (?:found|detected) that )?{_SCRIPTS} (?:is|are) (?:not active|not enabled|disabled|switched off|turned off)\b"
    + _REST
    + r"|(?P<again>[^.]{3,}?\.)(?: ?(?P=again)){2,}\W*"
    r"|(?P<word>[a-z]{2,})(?: (?P=word)){3,}\b.*"
    r"|(?:asdf|qwer|zxcv|blah|foo|test)(?: (?:asdf|qwer|zxcv|blah|foo|bar|test\w*|xxx|123)){5,}.*"
    r")",
    re.I,
)
_NAVIGATION = re.compile(
    r"^\s*(?:[\w ]{1,24}(?:\s*[>|»•/·]\s*[\w ]{1,24})+|\[[A-Z][a-z]+\]|(?:Reference|Request|Trace)(?: id)?:? ?[\w-]{4,40}\.?|Skip to (?:main )?content"
    r"|[<«‹] ?(?:Back|Previous).*|(?:Next|Back|Home|Search|Menu|Login|Sign in|Print|Share|Help|Contact|About)|\[?\[?\s*(?:Page )?[A-Z]?\d{1,6}\]?\]?|[-–—] ?\d+ ?[-–—]|p\. ?\d+|Page \d+)\s*$"
)

#: Characters with which a slot can begin; the shapes are tried only there.
_OPENS = re.compile(r"[{%$<\[(@#~«X]")


def has_slot(text: str) -> bool:
    text = text.replace("\n", " ")
    match = SLOT.match
    return any(match(text, m.start()) for m in _OPENS.finditer(text))


def _is_title(line: str) -> bool:
    if line.isupper():
        return True
    capitals = sum(map(line.count, _CAPITALS))
    # the commonest small letters alone rule most lines out
    if not capitals or capitals < 0.9 * (capitals + sum(map(line.count, "etao"))):
        return False
    return capitals >= 0.9 * sum(c.isalpha() for c in line)


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def passages(text: str) -> list[tuple[str, bool]]:
    """(line, whether it is trusted residue) of the lines that can hold content: no blank ones, titles or page navigation."""
    out = []
    for line in text.split("\n"):
        if not line or line.isspace():
            continue
        if _MAYBE(line) and TRUSTED.match(line):
            out.append((line, True))
        elif not (_is_title(line) or _is_short(line) or _NAVIGATION.match(line)):
            out.append((line, False))
    return out


#: What every trusted passage begins with or holds; the full patterns are tried only then.
_MAYBE_WORDS = re.compile(
    r"^\W*(?:lorem|http|error|[45]\d\d|not found|forbidden|internal|bad |service|gateway|too many|unauthori|\{\"|noscript|javascript|js\b|scripts?\b|client|script "
    r"|cookies|scripting|please|enable|turn on|switch on|activate|sorry|you do not|your session|unable|we (?:are|were) unable|we have (?:found|detected)|our |asdf|qwer|zxcv|blah|foo|test"
    r"|(?:the|this|that) (?:(?:upstream|remote|servers?|site|service)\b|[a-z]+ (?:you|could|was not|cannot|can't|has been|needs|requires)\b)"
    r"|([a-z]{2,}) \1 \1 \1)|^\W*([^.]{3,}\.) ?\2",
    re.I,
)
_MAYBE = _MAYBE_WORDS.search
_ENDED = (".", "?", "!", ":", ";")


def _is_short(line: str) -> bool:
    """A few words that are no sentence: menu entries, headings and the like."""
    if len(line) > 60:
        return False
    body = line.strip()
    words_in = body.split()
    return len(words_in) <= 4 and not body.endswith(_ENDED) or len(words_in) == 1 and body.endswith(("...", "…"))


class Model:
    """Log odds (residue against content) of each word bucket, of a record, and the log share of residue passages among those of content."""

    def __init__(self, residue: np.ndarray, content: np.ndarray, residue_records: float, records: float, stray: float, content_passages: float):
        both = residue + content
        both = both / both.sum()
        p = (1 - SMOOTHING) * residue / max(residue.sum(), 1e-9) + SMOOTHING * both
        q = (1 - SMOOTHING) * content / max(content.sum(), 1e-9) + SMOOTHING * both
        with np.errstate(divide="ignore", invalid="ignore"):
            odds = np.log(p) - np.log(q)
        # a word never seen is taken for one of content
        self.odds = np.clip(np.where(both > 0, odds, np.log(SMOOTHING)), -SURE, SURE)
        self.odds[0] = 0
        share = min(max(residue_records / max(records, 1), 1e-9), 0.5)
        self.prior = float(np.log(share) - np.log1p(-share))
        self.stray = float(min(max(stray / max(content_passages, 1), 1e-9), 0.5))

    def records(self, odds: np.ndarray, trusted: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log odds of each record, probability of each passage to be residue beside content), from the passages' log odds and their number in each record."""
        odds = np.where(trusted, np.maximum(odds, SURE), odds)
        beside = np.logaddexp(np.log1p(-self.stray), np.log(self.stray) + odds)
        return self.prior + _sums(odds - beside, passages), np.exp(np.log(self.stray) + odds - beside)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of ``sizes`` values."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _posterior(model: Model | None, odds: np.ndarray, trusted: np.ndarray, count: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability of each record to be residue, of each passage)."""
    sure = _sums(trusted, passages)
    labelled = (sure == passages) & (passages > 0)
    if model is None:
        # at first a record with a trusted passage and few other words may be either
        maybe = (sure > 0) & (_sums(np.where(trusted, 0, count), passages) <= FEATURES * COMPANION)
        record, beside = np.where(labelled, 1.0, np.where(maybe, 0.5, 0.0)), np.zeros(len(trusted))
    else:
        record, beside = model.records(odds, trusted, passages)
        record = np.where(labelled, 1.0, 1 / (1 + np.exp(-np.clip(record, -50, 50))))
    record[passages == 0] = 0
    whole = np.repeat(record, passages)
    return record, np.where(trusted, 1.0, whole + (1 - whole) * beside)


def _features(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of each word, its first and its last letters, one after another; number of them in each line)."""
    hashed, start, pieces = words_and_pieces(pa.array(lines, pa.large_string()))
    whole = np.concatenate([hashed[:, None], pieces], 1) >> np.uint64(64 - BUCKET_BITS)
    return whole.ravel().astype("<u2"), FEATURES * np.diff(start)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of at most SLICE rows, and of at most SLICE_BYTES of text where that is more than one row."""
    size = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))])
    at = 0
    while at < batch.num_rows:
        to = min(at + SLICE, batch.num_rows, max(at + 1, int(np.searchsorted(size, size[at] + SLICE_BYTES, "right")) - 1))
        yield batch.slice(at, to - at)
        at = to


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice: the ids, and packed arrays of slots, passages, their trust, lengths and words."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part in _slices(batch):
            slot, passages_in, lines, trusted = [], [], [], []
            for text in part.column(1).to_pylist():
                own = passages(text)
                slot.append(has_slot(text)), passages_in.append(len(own))
                lines += [x for x, _ in own]
                trusted += [t for _, t in own]
            bucket, size = _features(lines)
            shape = np.concatenate([np.array(slot, np.int32), np.array(passages_in, np.int32), np.array(trusted, np.int32), size.astype(np.int32)])
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
            blobs = [pa.array([pack.compress(x.astype(x.dtype.newbyteorder("<")).tobytes())], pa.binary()) for x in (shape, bucket)]
            yield pa.RecordBatch.from_arrays([ids, pa.array([part.num_rows], pa.int32()), *blobs], names=["ids", "n", "shape", "bucket"])


def _unpack(n: int, shape: bytes, bucket: bytes) -> tuple[np.ndarray, ...]:
    """(slots, passages of each record, trust, words of each passage, bucket of each word)."""
    unpack = zstandard.ZstdDecompressor()
    flat = np.frombuffer(unpack.decompress(shape), "<i4")
    slot, passages_in, rest = flat[:n] > 0, flat[n : 2 * n].astype(np.int64), flat[2 * n :]
    half = len(rest) // 2
    return slot, passages_in, rest[:half] > 0, rest[half:].astype(np.int64), np.frombuffer(unpack.decompress(bucket), "<u2")


def _counting(model: Model | None):
    """Word counts by posterior: cells 2 * bucket (residue) and 2 * bucket + 1 (content); then records and passages."""
    size = 1 << BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * size + 5)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, passages_in, trusted, count, bucket = _unpack(*row)
                odds = np.zeros(len(count)) if model is None else _sums(model.odds[bucket], count)
                record, weight = _posterior(model, odds, trusted, count, passages_in)
                each = np.bincount(bucket, np.repeat(weight, count), size)
                total[: 2 * size : 2] += each
                total[1 : 2 * size : 2] += np.bincount(bucket, minlength=size) - each
                content = 1 - np.repeat(record, passages_in)
                total[2 * size :] += (
                    record.sum(), np.count_nonzero(passages_in), np.maximum(weight - (1 - content), 0).sum(), content.sum(), trusted.sum(),
                )
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    return run


def parsed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All texts of ``df`` as hashed words of passages, written to the shared checkpoint folder (about 2 bytes a word before compression)."""
    ship(df.sparkSession)
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("trim(text) <> ''")
    return cut(source.mapInArrow(_parse, f"ids array<{source.schema['id'].dataType.simpleString()}>, n int, shape binary, bucket binary"))


def learn(slices: DataFrame, rounds: int = ROUNDS) -> Model | None:
    """The model from all ``parsed`` texts; None without a trusted passage.  The driver gets 2 ** 17 sums a round."""
    model, size, before = None, 1 << BUCKET_BITS, None
    for _ in range(rounds):
        cells = slices.select("n", "shape", "bucket").mapInArrow(_counting(model), "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        total = np.zeros(2 * size + 5)
        total[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy()
        if total[-1] == 0:
            return None
        model = Model(total[: 2 * size : 2], total[1 : 2 * size : 2], *total[2 * size : -1])
        if before is not None and abs(total[2 * size] - before) <= STEADY * before:
            break
        before = total[2 * size]
    return model


def verdict(text: str, model: Model | None) -> tuple[bool, float | None]:
    """(whether the text is residue, log odds of the record)."""
    if has_slot(text):
        return True, None
    found = passages(text)
    if not found or model is None:
        return False, None
    bucket, size = _features([x for x, _ in found])
    odds = _sums(model.odds[bucket], size)
    trusted = np.array([t for _, t in found])
    score = float(model.records(odds, trusted, np.array([len(found)]))[0][0])
    return bool(trusted.all() or score > 0), score


def residue(df: DataFrame, id_col: str, text_col: str, rounds: int = ROUNDS) -> DataFrame:
    """(id, has_slot): the documents to leave out."""
    slices = parsed(df, id_col, text_col)
    model = learn(slices, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                slot, passages_in, trusted, count, bucket = _unpack(*(batch.column(c)[i].as_py() for c in ("n", "shape", "bucket")))
                found = slot
                if model is not None:
                    record, _ = _posterior(model, _sums(model.odds[bucket], count), trusted, count, passages_in)
                    found = slot | (record > 0.5)
                at = pa.array(np.flatnonzero(found))
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values.take(at), pa.array(slot).take(at)], names=["id", "has_slot"])

    return slices.mapInArrow(run, f"id {slices.schema['ids'].dataType.elementType.simpleString()}, has_slot boolean")
