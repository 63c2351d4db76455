"""One plain form for text that looks the same but is coded differently.

A weighted edit automaton runs over the trie of a vocabulary.  Look-alikes and
ignorable characters cost nothing; a letter of a script in which no word of the
vocabulary is written may stand for any letter, or for none, at a cost of 1 each,
up to ``BUDGET``.  Letters of the vocabulary's scripts are never exchanged, so a
word in plain form is never taken for another one.  A token that reaches one word takes its spelling;
the others are normalised by table.
"""

from __future__ import annotations

import heapq
import unicodedata
import uuid
from dataclasses import dataclass
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_VOCABULARY = 1_000_000  # entries; the words go to every worker, about 60 MB at this bound
BUDGET = 2  # letters of foreign scripts that a match may explain

# Closing marks, as written plainly.
CLOSING = "।,?"
# Letters of other scripts drawn like a Latin letter.
LATIN = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Ѵ": "V", "Х": "X", "Ԝ": "W",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a", "ո": "n", "ս": "u", "օ": "o", "ⅼ": "l",
}
# Marks drawn like the usual one.
MARKS = {
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹣": "-", "－": "-", "⁃": "-",
    "৷": "।", "|": "।", "｜": "।", "ǀ": "।", "∣": "।", "।": "।", "︱": "।", "，": ",", "‚": ",", "﹐": ",", "،": ",", "？": "?", "﹖": "?", "؟": "?", "’": "'", "ʼ": "'", "＇": "'", "٪": "%", "％": "%",
}
# Bengali sequences drawn like one letter.
BENGALI = {
    "অা": "আ", "ব়": "র", "ত্‍": "ৎ", "ওৗ": "ঔ", "ঋৃ": "ৠ", ":": "ঃ", "꞉": "ঃ", "ː": "ঃ", "：": "ঃ",
}
# Signs and danda that the scripts of the region share in shape: those of the same name.
_SIGNS = ("CANDRABINDU", "ANUSVARA", "VISARGA", "NUKTA", "VIRAMA")
for _c in map(chr, range(0x0900, 0x0E00)):
    _name = unicodedata.name(_c, "").split(" SIGN ")
    if len(_name) == 2 and _name[0] != "BENGALI" and _name[1] in _SIGNS:
        BENGALI[_c] = unicodedata.lookup(f"BENGALI SIGN {_name[1]}")
_STARTS: dict[str, list[tuple[str, str]]] = {}
for _seq, _plain in BENGALI.items():
    _STARTS.setdefault(unicodedata.normalize("NFD", _seq)[0], []).append((unicodedata.normalize("NFD", _seq), unicodedata.normalize("NFD", _plain)))

_VIRAMA, _JOINER = "্", "‍"


def ignorable(c: str) -> bool:
    """Characters that leave no trace: format characters, blanks, controls, fillers."""
    return unicodedata.category(c) in ("Cf", "Zs", "Zl", "Zp", "Cc") or c in "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ" or "︀" <= c <= "️"


def _script(c: str) -> str:
    return unicodedata.name(c, "?").split(" ")[0]


def _wide(c: str) -> str:
    """Full- and half-width, circled and styled letters as the plain letter."""
    kind = unicodedata.decomposition(c).split(" ")[0]
    return unicodedata.normalize("NFKC", c) if kind in ("<wide>", "<narrow>", "<font>", "<circle>", "<compat>") and len(unicodedata.normalize("NFKC", c)) <= 3 else c


class PlainForms:
    """Plain forms of tokens against a vocabulary; immutable but for its cache."""

    def __init__(self, words: Iterable[str], budget: int = BUDGET, closing: str = CLOSING) -> None:
        words = set(words)
        self.budget, self.closing = budget, closing
        self.words = frozenset(w for w in words if w == unicodedata.normalize("NFC", w))
        self.children: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        for w in sorted(set(words)):
            node = 0
            for c in unicodedata.normalize("NFD", w):
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word.append(None)
                node = nxt
            self.word[node] = w
        self.scripts = {_script(c) for here in self.children for c in here} | {"COMBINING"}
        self.cache: dict[str, str] = {}

    def _foreign(self, c: str) -> bool:
        """A letter or sign of a script that no word of the vocabulary is written in; accents are of all."""
        return unicodedata.category(c)[0] in "LM" and not ignorable(c) and _script(c) not in self.scripts

    def _descend(self, node: int, text: str) -> int | None:
        for c in text:
            nxt = self.children[node].get(c)
            if nxt is None:
                return None
            node = nxt
        return node

    def _moves(self, node: int, text: str, i: int) -> Iterator[tuple[int, int, int]]:
        """(cost, node, position) reachable by one step of the automaton."""
        c, here = text[i], self.children[node]
        for seq, plain in _STARTS.get(c, ()):
            # what is drawn over nothing may stand between the parts of a sequence
            end = self._through(text, i, seq)
            to = self._descend(node, plain) if end else None
            if to is not None:
                yield 0, to, end
        if ignorable(c):
            yield 0, node, i + 1
        likes = {c, LATIN.get(c, c), MARKS.get(c, c), *(LATIN.get(x, x) for x in [_wide(c)])}
        for like in likes:
            to = self._descend(node, unicodedata.normalize("NFD", like))
            if to is not None:
                yield 0, to, i + 1
        if self.budget and self._foreign(c):
            yield 1, node, i + 1
            for to in here.values():
                yield 1, to, i + 1

    @staticmethod
    def _through(text: str, i: int, seq: str) -> int:
        """Position behind ``seq`` at ``i``, passing over ignorables inside it; 0 if it isn't there."""
        for k, c in enumerate(seq):
            while k and i < len(text) and text[i] != c and ignorable(text[i]):
                i += 1
            if i >= len(text) or text[i] != c:
                return 0
            i += 1
        return i

    def _rest(self, text: str) -> str | None:
        """The closing mark that ``text`` amounts to, '' for none, None for more."""
        left = [MARKS.get(_wide(c), MARKS.get(c, _wide(c))) for c in text if not ignorable(c)]
        return "".join(left) if not left or (len(left) == 1 and left[0] in self.closing) else None

    def match(self, token: str) -> str | None:
        """The vocabulary's spelling of ``token``, with its closing mark.

        The words of least cost are looked at; if there are several, all but equal
        to the eye, none is taken.
        """
        text = unicodedata.normalize("NFD", token)
        heap, done = [(0, len(text), 0)], set()  # cost, characters still to read, node
        found: set[str] = set()
        least = self.budget
        while heap:
            cost, left, node = heapq.heappop(heap)
            if cost > least or (left, node) in done:
                continue
            done.add((left, node))
            at = len(text) - left
            if self.word[node] is not None:
                mark = self._rest(text[at:])
                if mark is not None:
                    found.add(self.word[node] + mark)
                    least = cost
            if left:
                for c, to, pos in self._moves(node, text, at):
                    if cost + c <= least and (len(text) - pos, to) not in done:
                        heapq.heappush(heap, (cost + c, len(text) - pos, to))
        return found.pop() if len(found) == 1 else None

    @staticmethod
    def by_table(token: str) -> str:
        """NFC without ignorables, look-alikes put in the script of their neighbours."""
        kept = "".join(c for i, c in enumerate(token) if not ignorable(c) or (c == _JOINER and i and token[i - 1] == _VIRAMA))
        text = unicodedata.normalize("NFD", "".join(_wide(c) for c in kept))
        bengali = any(_script(c) == "BENGALI" for c in text)
        latin = any(_script(c) == "LATIN" for c in text)
        foreign = [c for c in text if _script(c) in ("CYRILLIC", "GREEK", "ARMENIAN")]
        # a word wholly in another script stays; one letter among Latin ones, or all of them look-alikes beside Bengali, is read as Latin
        if foreign and (latin or bengali) and all(c in LATIN for c in foreign):
            text = "".join(LATIN.get(c, c) for c in text)
        if bengali:
            for seq, plain in BENGALI.items():
                if seq in (":", "꞉", "ː", "："):
                    continue
                text = text.replace(seq, plain)
            chars = list(text)
            for i in range(1, len(chars) - 1):
                # between letters or signs it is a visarga, between digits a colon
                if chars[i] in ":꞉ː" and all(_script(c) == "BENGALI" and unicodedata.category(c)[0] in "LM" for c in (chars[i - 1], chars[i + 1])):
                    chars[i] = "ঃ"
            text = "".join(MARKS.get(c, c) for c in chars)
        return unicodedata.normalize("NFC", text.replace(_JOINER, ""))

    def __call__(self, token: str | None) -> str | None:
        """Plain form; null stays null, a token of ignorables only becomes ''."""
        if token is None:
            return None
        got = self.cache.get(token)
        if got is None:
            if len(self.cache) > 1 << 17:
                self.cache.clear()
            # in plain form already: the automaton would reach the same word at no cost
            same = token in self.words or (token[:-1] in self.words and token[-1:] in self.closing)
            got = token if same else self.match(token)
            got = self.cache[token] = self.by_table(token) if got is None else got
        return got


def bengali_rest(word: str) -> str:
    """The letters of the Bengali block of a word."""
    return "".join(c for c in word if "ঀ" <= c <= "৿")


def vocabulary(df: DataFrame, line: str = "line", most: int = MAX_VOCABULARY) -> list[str]:
    """First tab field of each line, trimmed, blanks dropped; refuses more than ``most``."""
    rows = df.select(F.trim(F.split(line, "\t")[0]).alias("w")).where("w <> ''").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a vocabulary of over {most} words is no vocabulary to send to every worker")
    return [r["w"] for r in rows]


@dataclass(frozen=True)
class Forms:
    """What a worker builds its plain forms from."""

    words: tuple[str, ...]
    budget: int = BUDGET
    closing: str = CLOSING


_built: dict[str, dict[str, PlainForms]] = {}


def add_plain_forms(df: DataFrame, forms: dict[str, Forms]) -> DataFrame:
    """``df`` with a column ``<name>_plain`` for each string column in ``forms``.

    The words are broadcast once; each worker builds its tries from them once.
    Each different string of an Arrow batch is looked up once.  A column of that
    name in ``df`` is replaced; null stays null.
    """
    df = df.drop(*[f"{c}_plain" for c in forms])
    schema = T.StructType([*df.schema.fields, *[T.StructField(f"{c}_plain", T.StringType()) for c in forms]])
    sent, name = df.sparkSession.sparkContext.broadcast(forms), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _built:
            _built.clear()
            _built[name] = {c: PlainForms(f.words, f.budget, f.closing) for c, f in sent.value.items()}
        for b in batches:
            out = list(b.columns)
            for c, form in _built[name].items():
                coded = b.column(c).dictionary_encode()
                plain = pa.array([form(x) for x in coded.dictionary.to_pylist()], pa.string())
                out.append(plain.take(coded.indices) if b.num_rows else pa.array([], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return df.mapInArrow(run, schema)


def word_forms(words: list[str], budget: int = BUDGET) -> dict[str, Forms]:
    """Forms for ``word`` (with closing marks) and ``label`` (Bengali letters only)."""
    return {"word": Forms(tuple(words), budget), "label": Forms(tuple(r for w in words if (r := bengali_rest(w))), budget, closing="")}
