"""Text from scanned pages: misread words, broken words, running heads and page numbers.

1. Words are counted over the whole collection (numpy per task, then one
   aggregation by hash).  Known words are those with a share of at least
   ``KNOWN_SHARE`` of all words, so there are at most 1 / ``KNOWN_SHARE`` of them.
2. Skip-gram vectors: (word, neighbour within two places) pairs of known words are
   counted over the whole collection, neighbours hashed to ``CONTEXTS`` places.
   Pointwise mutual information (shrunk where little is expected), whose
   factorization is what skip-gram with negative sampling learns, and a singular
   value decomposition of the bounded matrix give vectors of words and contexts.
3. A rare word is linked to the known words from which plausible glyph edits lead
   to it and which are its neighbours in the vector space: where both have vectors,
   theirs must point the same way, and the linked word must fit the vectors of the
   words around.  The best fit is taken; if none fits, or nothing around is known,
   the word stays as it is.
4. Furniture is recognised by its shape, misread letters allowed; words broken at
   a line's end are joined unless they are a compound that keeps its hyphen; the
   rest is reflowed into paragraphs.

Only texts that are set in lines (a line without a sentence's end goes on in a
lower-case line) are taken for scanned.  Defined results: NULL and empty texts and
texts not from scans have no faulty lines and are returned as they are; equal ids
are repaired row by row; an empty table gives no rows.  Lines of more than
``_WIDEST`` characters are no running heads and no lines of a page; tokens of more
than ``_LONGEST`` are no words; a word's rest is looked for in the next three lines
of running text (stray lines may stand between).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, ship
from .shingles import words

KNOWN_SHARE, VECTOR_SHARE, CONTEXTS, WINDOW, DIMENSIONS = 2e-6, 1e-5, 128, 2, 32
FIT, ALIKE = -1.5, 0.3  #: least mean information of a linked word with the words around; least cosine with the form's own vector
HELD = 200_000  #: forms whose links are remembered at a time
_WIDEST = 90

#: What a scanner reads (left) for what was printed (right).
GLYPHS = [
    ("c", "e"), ("e", "c"), ("b", "h"), ("h", "b"), ("ii", "u"), ("u", "ii"), ("cl", "d"), ("d", "cl"), ("rn", "m"), ("m", "rn"),
    ("ri", "n"), ("n", "ri"), ("vv", "w"), ("w", "vv"), ("h", "li"), ("li", "h"), ("i", "l"), ("l", "i"), ("n", "u"), ("u", "n"),
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("8", "b"), ("6", "b"), ("9", "g"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"),
    ("†", "t"), ("ã", "a"), ("f", "e"), ("x", "n"), ("ni", "m"), ("in", "m"), ("nn", "m"), ("tl", "d"), ("fi", "h"),
    ("ﬁ", "fi"), ("ﬂ", "fl"),
]
STRAY = "~^·|¦*`´¨°•_\\"
_HYPHENS = "-‐‑¬\xad"
_MONTHS = "JANUARY FEBRUARY MARCH APRIL MAY JUNE JULY AUGUST SEPTEMBER OCTOBER NOVEMBER DECEMBER".split()
_CAPS = str.maketrans("0158", "OISB")

_FOLIO = re.compile(r"^(?:[\[(]\s*\d{1,6}\s*[\])]|[-–—]+\s*\d{1,6}\s*[-–—]+|(?:[Pp](?:age|AGE|\.|p\.)|No\.)\s*[A-Z]?\d{1,6}\.?|[A-Z]{0,2} ?\d{1,6})$")
_DAY = re.compile(r"^(?:[A-Za-z]{6,9}day,? |[A-Z]{6,9},? )?([A-Za-z0-9|!]{3,10})\.? (\d{1,2}|[0-9lIOo]{1,2})(?:, ?\d{4})?[.,]?$")


def _within(a: str, b: str, most: int) -> bool:
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= most


def _is_month(word: str) -> bool:
    word = word.upper().translate(_CAPS)
    # one slip leaves the first letter or the last
    return word in _MONTHS or any(len(m) > 3 and (word[0] == m[0] or word[-1] == m[-1]) and _within(word, m, 1) for m in _MONTHS)


_SMALL = re.compile(r"[a-zß-öø-ÿ]")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_TWO_SMALL = re.compile(r"[a-km-zß-öø-ÿ].*[a-km-zß-öø-ÿ]")


def furniture(line: str) -> str | None:
    """'header', 'folio' or None."""
    s = line.strip()
    if not s or len(s) > _WIDEST:
        return None
    if len(s) <= 45:  # longer lines are neither a number nor a day
        if _FOLIO.match(s):
            return "folio"
        day = _DAY.match(s)
        if day and _is_month(day[1]):
            return "header"
    if _TWO_SMALL.search(s):
        return None
    letters = re.sub(r"[^A-Z]", "", s.upper().translate(_CAPS))
    if len(letters) < 15:
        return "header" if re.fullmatch(r"(?:\d+ )?(?:SENATE|HOUSE OF REPRESENTATIVES|EXTENSIONS OF REMARKS)(?: \d+)?", s) else None
    if "CONGRESSIONALRECORD" in letters:
        return "header"
    for word, most in (("CONGRESSIONALRECORD", 3),):
        for at in range(0, max(1, len(letters) - len(word) + most + 1)):
            for size in range(len(word) - 2, len(word) + 2):
                part = letters[at : at + size]
                if part[:1] in "C0GOR" and part[-2:].endswith(("D", "O", "R")) and _within(part, word, most):
                    return "header"
    if _within(letters, "EXTENSIONSOFREMARKS", 2) or _within(letters, "HOUSEOFREPRESENTATIVES", 2):
        return "header"
    return None


def is_title(line: str) -> bool:
    capitals = len(_CAPITAL.findall(line))
    return capitals >= 7 and capitals + (small := len(_SMALL.findall(line))) >= 8 and capitals > 0.85 * (capitals + small)


_END = re.compile(r"[.?!:;][\"'”’)\]]*\s*$")


def is_scanned(lines: list[str], shape: list[str | None] | None = None) -> bool:
    """Whether the text is set in lines: one goes on in the next without a sentence's end, in lower case."""
    shape = [furniture(x) for x in lines] if shape is None else shape
    running = [x for x, kind in zip(lines, shape, strict=True) if not kind and x and not x.isspace()]
    for a, b in zip(running, running[1:]):
        a, b = a.rstrip(), b.lstrip()
        if len(a) <= _WIDEST and (b[:1].islower() or a[-1:] in _HYPHENS) and not _END.search(a) and not is_title(a):
            return True
    return False


class Lexicon:
    """Known words by hash, with counts, and skip-gram vectors of the more frequent ones (broadcast by closure; its size is bounded)."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, surely: float = 1):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        self.surely = surely  #: count from which a word is no misreading of another
        self.vector_hashes = self.vectors = self.contexts = None
        self.cache: dict[str, int] = {}
        self.linked: dict[str, list[tuple[str, int]]] = {}
        self.placed: dict[str, tuple[int, int] | None] = {}
        self.fine: set[str] = set()  #: tokens that no context makes faulty

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "linked": {}, "placed": {}, "fine": set()}

    def count(self, forms: list[str]) -> list[int]:
        new = [f for f in dict.fromkeys(forms) if f not in self.cache]
        if new:
            if len(self.cache) > HELD:
                self.cache.clear()
                new = list(dict.fromkeys(forms))
            hashed, start = words(pa.array(new, pa.string()))
            one = np.diff(start) == 1
            at = np.searchsorted(self.hashes, hashed)
            at[at == len(self.hashes)] = 0
            hit = np.where(self.hashes[at] == hashed, self.counts[at], 0) if len(self.hashes) else np.zeros(len(hashed), np.int64)
            for i, f in enumerate(new):
                self.cache[f] = int(hit[start[i]]) if one[i] else 0
        return [self.cache[f] for f in forms]

    def place(self, word: str) -> tuple[int, int] | None:
        """(row among the vectors, place among the contexts) of a word with a vector."""
        if word not in self.placed:
            if len(self.placed) > HELD:
                self.placed.clear()
            found = None
            if self.vectors is not None and len(self.vectors):
                hashed, _ = words(pa.array([word], pa.string()))
                if len(hashed) == 1:
                    at = int(np.searchsorted(self.vector_hashes, hashed[0]))
                    if at < len(self.vector_hashes) and self.vector_hashes[at] == hashed[0]:
                        found = at, int(_context_place(hashed)[0])
            self.placed[word] = found
        return self.placed[word]

    def links(self, form: str) -> list[tuple[str, int]]:
        """Known words, with counts, from which plausible glyph edits lead to ``form``."""
        if form not in self.linked:
            if len(self.linked) > HELD:
                self.linked.clear()
            self.linked[form] = _links(form, self)
        return self.linked[form]

    def alike(self, form: str, word: str) -> bool:
        """Whether the vectors of a form and a word point the same way; True where the form has none of its own."""
        a, b = self.place(form), self.place(word)
        if a is None or b is None:
            return True
        x, y = self.vectors[a[0]], self.vectors[b[0]]
        return float(x @ y) >= ALIKE * float(np.linalg.norm(x) * np.linalg.norm(y))

    def choose(self, form: str, around: list[str] | None) -> str | None:
        """The linked word that fits the words around best; None if none does or nothing around is known.  ``around`` None: some linked word."""
        if around is None:
            return self.links(form)[0][0]
        found = [w for w, _ in self.links(form) if self.place(w) is not None and self.alike(form, w)]
        near = [p[1] for p in map(self.place, around) if p is not None] if found else []
        if not near:
            return None
        middle = self.contexts[near].mean(0)
        fit, word = max((float(self.vectors[self.place(w)[0]] @ middle), w) for w in found)
        return word if fit >= FIT else None


def _context_place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % CONTEXTS


_LOWER_WORD = re.compile(r"[a-z]+")


def _undone(form: str, twice: bool) -> set[str]:
    """Forms from which one glyph edit (or two) leads to ``form``."""
    out = set()
    for read, printed in GLYPHS:
        at = form.find(read)
        while at >= 0:
            out.add(form[:at] + printed + form[at + len(read) :])
            at = form.find(read, at + 1)
    if twice:
        for f in list(out):
            out |= _undone(f, False)
    out.discard(form)
    return out


_ODD = re.compile(r"[^a-z'’-]")
_STRAY = re.compile(f"[{re.escape(STRAY)}]")
_INNER_STRAY = re.compile(rf"(?<=[^\W\d_])[{re.escape(STRAY)}](?=[^\W\d_])")


def _links(form: str, lexicon: Lexicon) -> list[tuple[str, int]]:
    odd = bool(_ODD.search(form))
    if not odd and len(form) < 3:
        return []
    have = lexicon.count([form])[0] if not odd else 0
    plain = _STRAY.sub("", form)
    options = {plain} if plain != form and len(plain) > 1 else set()
    options |= _undone(form, False)
    if plain != form:
        options |= _undone(plain, False)
    options = sorted(o for o in options if _LOWER_WORD.fullmatch(o))
    found = [(o, c) for o, c in zip(options, lexicon.count(options), strict=True) if c > 0 and c >= 20 * have]
    if not found and odd:
        options = sorted(o for o in _undone(plain, True) if _LOWER_WORD.fullmatch(o))
        found = [(o, c) for o, c in zip(options, lexicon.count(options), strict=True) if c > 0]
    return found


def correct(form: str, lexicon: Lexicon, around: list[str] | None) -> str | None:
    """The known word that ``form`` (lower case) was read for, or None if it is none or correct."""
    return lexicon.choose(form, around) if lexicon.links(form) else None


def _word_fault(core: str, lexicon: Lexicon, around: list[str] | None) -> str | None:
    """The corrected word of a faulty token, or None.  ``core``: the token without outer punctuation."""
    low = core.lower()
    if low.endswith(("'s", "’s")):
        core, low = core[:-2], low[:-2]
    if not any(c.isalpha() for c in core):
        return None
    if re.fullmatch(r"[A-Za-z]+(?:['’.-][A-Za-z]+)*", core):
        if "I" in core[1:] and any(c.islower() for c in core):  # I for l inside a word
            plain = core.replace("I", "l").lower()
            return plain if lexicon.count([plain])[0] else correct(plain, lexicon, around)
        if "-" in core or "." in core or "'" in core or "’" in core:
            for part in re.split(r"['’.-]", core):
                if len(part) > 2 and (fixed := _word_fault(part, lexicon, around)):
                    return fixed
            return None
        return correct(low, lexicon, around)
    if re.fullmatch(r"[$£]?[\d.,:/-]+(?:st|nd|rd|th|d|s|a|p|am|pm|%)?|[A-Z]{1,4}\.?-?\d+|\d+[-–][\w-]+", core) or re.search(r"\d{2}", core):
        return None
    inner = _INNER_STRAY.search(core)
    fixed = correct(low, lexicon, around)
    if fixed:
        return fixed
    if inner:
        return _STRAY.sub("", low)
    if re.search(r"[a-z][†ã0158!|][a-z]|[†ãﬁﬂ]", core):
        return low.translate(str.maketrans("†ã0158!|", "taolsbil")).replace("ﬁ", "fi").replace("ﬂ", "fl")
    return None


def _is_fine(core: str, lexicon: Lexicon) -> bool:
    """Whether a token is faulty in no context."""
    if core not in lexicon.fine:
        low = core.lower()
        if not (low.isascii() and low.isalpha() and lexicon.count([low])[0] >= lexicon.surely and not ("I" in core[1:] and not core.isupper())):
            if _word_fault(core, lexicon, None) not in (None, low):
                return False
        if len(lexicon.fine) > HELD:
            lexicon.fine.clear()
        lexicon.fine.add(core)
    return True


_LONGEST = 60
_PIECE = re.compile(rf"([^\W\d_][\w{re.escape(STRAY)}!†]*)[{_HYPHENS}]\s*$")


def _broken_end(line: str) -> re.Match | None:
    """The piece of a word (group 1) with a hyphen at the end of a line."""
    tail = line.rstrip()
    if tail[-1:] not in _HYPHENS or not tail:
        return None
    return _PIECE.search(line, max(0, len(tail) - _LONGEST))


_TOKEN = re.compile(r"\S+")
_HYPHENATED = re.compile(rf"[^{_HYPHENS}–—]+")
#: Outer punctuation; a misread letter at an end is kept.
_BEFORE = re.compile(r"(?:(?!†)(?![!|](?=\w)(?=[^\W\d_A-Z]))[\W_])+")
_BEHIND = re.compile(r"(?:(?!†)[\W_])+$")


def _tokens(line: str) -> list[tuple[int, str]]:
    """(place, core) of the tokens of a line, without outer punctuation; a token of more than ``_LONGEST`` characters is split at its dashes."""
    out = []
    for m in _TOKEN.finditer(line):
        raw, place = m[0], m.start()
        if len(raw) > _LONGEST:
            for piece in _HYPHENATED.finditer(raw):
                if len(piece[0]) <= _LONGEST and (core := _trimmed(piece[0]))[1]:
                    out.append((place + piece.start() + core[0], core[1]))
        elif raw.isalnum():
            out.append((place, raw))
        elif (core := _trimmed(raw))[1]:
            out.append((place + core[0], core[1]))
    return out


def _trimmed(raw: str) -> tuple[int, str]:
    before = _BEFORE.match(raw)
    start = before.end() if before else 0
    behind = _BEHIND.search(raw, start)
    return start, raw[start : behind.start() if behind else len(raw)]


def faults(text: str, lexicon: Lexicon, fixes: list | None = None) -> list[tuple[int, str]]:
    """(line_no, kind) of the faulty lines of one text.  ``fixes`` gets (line index, place, core, word) and joins (line index, None, next index, word)."""
    lines = text.split("\n")
    shape = [furniture(x) for x in lines]
    if not is_scanned(lines, shape):
        return []
    found = [(i + 1, s) for i, s in enumerate(shape) if s]
    running = [i for i, x in enumerate(lines) if not shape[i] and x and not x.isspace() and not is_title(x)]
    tokens = {i: _tokens(lines[i]) for i in running}
    flow = [(i, place, core) for i in running for place, core in tokens[i]]
    starts, n = {}, 0
    for i in running:
        starts[i] = n
        n += len(tokens[i])

    def around(first: int, last: int) -> list[str]:
        return [c.lower() for _, _, c in flow[max(0, first - WINDOW) : first] + flow[last + 1 : last + 1 + WINDOW]]

    skip: set[int] = set()  # places in the flow of pieces of broken words
    glyph: set[int] = set()
    for k, i in enumerate(running):
        if not tokens[i] or not _broken_end(lines[i]):
            continue
        at = starts[i] + len(tokens[i]) - 1
        piece = re.split(r"[-–—]", flow[at][2].lower())[-1]
        best = None
        for j in running[k + 1 : k + 4]:
            if not tokens[j]:
                continue
            head = re.split(r"[-–—]", tokens[j][0][1].lower())[0]
            joined, whole = piece + head, lexicon.count([piece + head])[0]
            if whole or (fixed := correct(joined, lexicon, around(at, starts[j]))):
                best = (j, head, joined if whole else fixed)
                if not whole:
                    glyph.add(i if not fixed.startswith(piece) else j)
                break
            if best is None:
                best = (j, head, None)
        if best is None:
            continue
        j, head, word = best
        if word is None:
            a, b = lexicon.count([piece, head])
            if a and b or not head[:1].isalpha() or lines[j].lstrip()[:1].isupper() and not lines[i].rstrip()[:-1][-1:].isupper():
                continue  # a compound that keeps its hyphen, or no continuation
            word = piece + head
        found.append((i + 1, "split"))
        skip |= {at, starts[j]}
        if fixes is not None:
            fixes.append((i, None, j, word))
    for at, (i, place, core) in enumerate(flow):
        if core in lexicon.fine or at in skip or _is_fine(core, lexicon):
            continue
        fixed = _word_fault(core, lexicon, around(at, at))
        if fixed and fixed != core.lower():
            glyph.add(i)
            if fixes is not None:
                fixes.append((i, place, core, fixed))
    return sorted(set(found) | {(i + 1, "glyph") for i in glyph})


def _cased(core: str, word: str) -> str:
    letters = [c for c in core if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return word.upper()
    return word[:1].upper() + word[1:] if core[:1].isupper() else word


def repaired(text: str, lexicon: Lexicon) -> str:
    """Continuous paragraphs: corrected words, joined pieces, no furniture."""
    lines = text.split("\n")
    shape = [furniture(x) for x in lines]
    if not is_scanned(lines, shape):
        return text
    fixes: list = []
    faults(text, lexicon, fixes)
    joins = {i: (j, word) for i, place, j, word in fixes if place is None}
    for i, place, core, word in sorted((f for f in fixes if f[1] is not None), key=lambda f: -f[1]):
        lines[i] = lines[i][:place] + _cased(core, word) + lines[i][place + len(core) :]
    for i, (j, word) in joins.items():
        stem = _broken_end(lines[i])
        nxt = re.match(r"\s*([^\s–—-]+)(.*)$", lines[j], re.S)
        if stem and nxt:
            tail = re.search(r"[.,;:?!)\]\"'”’]*$", nxt[1])[0]
            lines[i] = lines[i][: stem.start(1)] + _cased(stem[1], word) + tail
            lines[j] = nxt[2].lstrip() if not nxt[2].startswith(("-", "–", "—")) else nxt[2]
            if nxt[2].startswith(("-", "–", "—")):
                lines[i] += nxt[2].split(" ")[0]
                lines[j] = nxt[2].partition(" ")[2]
    out: list[str] = []
    open_line = False
    for i, line in enumerate(text.split("\n")):
        body = lines[i].strip()
        if shape[i] or not body:
            continue
        indented = len(line) - len(line.lstrip()) >= 1
        if open_line and not is_title(line) and not (indented and _END.search(out[-1])):
            glue = "" if out[-1].endswith(tuple(_HYPHENS)) and not out[-1].endswith(" -") and out[-1][-2:-1].isalpha() else " "
            out[-1] += glue + body
        else:
            out.append(body)
        open_line = not is_title(line)
    return "\n".join(out)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, counts, held = [], [], 0

    def merge():
        k, c = np.concatenate(keys), np.concatenate(counts)
        k, at = np.unique(k, return_inverse=True)
        return k, np.bincount(at, weights=c).astype(np.int64)

    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            k, c = np.unique(words(batch.column(0).slice(a, 1000))[0], return_counts=True)
            keys.append(k), counts.append(c)
            held += len(k)
            if held > 2_000_000:
                k, c = merge()
                keys, counts, held = [k], [c], len(k)
                if held > 1_000_000:  # many words: hand them on
                    yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["word", "n"])
                    keys, counts, held = [], [], 0
    if keys:
        k, c = merge()
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["word", "n"])


def _count_contexts(hashes: np.ndarray):
    """(cell, n): how often a neighbour of hash place cell % CONTEXTS stood near the word number cell // CONTEXTS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _context_place(hashes)
        cells, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def merge() -> tuple[np.ndarray, np.ndarray]:
            cell, at = np.unique(np.concatenate(cells), return_inverse=True)
            return cell, np.bincount(at, weights=np.concatenate(counts), minlength=len(cell)).astype(np.int64)

        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                hashed, start = words(batch.column(0).slice(a, 1000))
                at = np.searchsorted(hashes, hashed)
                at[at == len(hashes)] = 0
                known = hashes[at] == hashed
                doc = np.repeat(np.arange(len(start) - 1), np.diff(start))
                both = []
                for gap in range(1, WINDOW + 1):
                    pair = known[gap:] & known[:-gap] & (doc[gap:] == doc[:-gap])
                    x, y = at[gap:][pair], at[:-gap][pair]
                    both += [x * CONTEXTS + place[y], y * CONTEXTS + place[x]]
                cell, n = np.unique(np.concatenate(both), return_counts=True)
                cells.append(cell), counts.append(n)
                held += len(cell)
                if held > 4_000_000:
                    cell, n = merge()
                    cells, counts, held = [cell], [n], len(cell)
                    if held > 2_000_000:  # many cells: hand them on
                        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], names=["cell", "n"])
                        cells, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        cell, n = merge()
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], names=["cell", "n"])

    return run


def learn(df: DataFrame, text_col: str) -> Lexicon:
    """Known words and their skip-gram vectors, from all texts of ``df``."""
    ship(df.sparkSession)
    texts = df.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    counted = texts.mapInArrow(_count_words, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = cut(counted)
    total = counted.agg(F.sum("n")).first()[0] or 0
    # rows with a share of KNOWN_SHARE of the sum: at most 1 / KNOWN_SHARE of them come to the driver
    known = counted.where(F.col("n") >= max(4, KNOWN_SHARE * total)).toPandas()
    hashes, counts = known["word"].to_numpy(np.int64).view(np.uint64), known["n"].to_numpy(np.int64)
    lexicon = Lexicon(hashes, counts, surely=max(1, 1e-3 * total))
    often = lexicon.hashes[lexicon.counts >= max(1, VECTOR_SHARE * total)]
    if not len(often):
        return lexicon
    cells = texts.mapInArrow(_count_contexts(often), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    matrix = np.zeros(len(often) * CONTEXTS)
    matrix[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    matrix = matrix.reshape(len(often), CONTEXTS)
    expected = matrix.sum(1, keepdims=True) * matrix.sum(0, keepdims=True) / max(matrix.sum(), 1)
    information = np.log((matrix + 1) / (expected + 1))
    _, _, turn = np.linalg.svd(information.T @ information)
    lexicon.contexts = turn[:DIMENSIONS].T.astype(np.float32)
    lexicon.vector_hashes, lexicon.vectors = often, (information @ turn[:DIMENSIONS].T).astype(np.float32)
    return lexicon


def faulty_lines(df: DataFrame, id_col: str, text_col: str, lexicon: Lexicon | None = None) -> DataFrame:
    """(id, line_no, kind) with kind header, folio, split or glyph; lines count from 1."""
    lexicon = learn(df, text_col) if lexicon is None else lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, line, kind = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for n, k in faults(text, lexicon):
                    at.append(i), line.append(n), kind.append(k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(line, pa.int32()), pa.array(kind, pa.string())], names=["id", "line_no", "kind"]
            )

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").contains("\n"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, line_no int, kind string")


def repair(df: DataFrame, text_col: str, out_col: str = "repaired_text", lexicon: Lexicon | None = None) -> DataFrame:
    """``df`` with ``out_col``: the text as continuous paragraphs."""
    lexicon = learn(df, text_col) if lexicon is None else lexicon

    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: t if t is None or "\n" not in t else repaired(t, lexicon))

    return df.withColumn(out_col, run(F.col(text_col)))
