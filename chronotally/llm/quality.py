"""Quality rules, line first: bad lines go, then documents that lost too much of their words.

Each line with a word is judged on its own:

* **navigation**: at least three words that are only separators, a fifth of its words or more
* **symbols**: a tenth or more of its characters are of ``#*$%&|<>``, and there are five or more
* **punctuation**: twenty words or more and no mark that ends a sentence, of any script, anywhere
* **boilerplate**: at most 40 words with a notice or consent banner, or at most twelve that begin
  with a phrase of menus or prompts or mostly hold one; such phrases inside of prose do not count.
  Phrases are English, German, French and Spanish; other languages have the other three rules.

The numbers are parameters (:class:`LineRules`).

Lines without a word are kept as they are. Bytes that are no UTF-8 are kept as well; the rules take them for marks of no kind. What is left is the cleaned text. A document is
rejected if it fails the base rules (fewer than ten words, or over a fifth of its words in
repeated windows of five), or if its bad lines hold more than ``max_lost`` of its words.

A null text counts as empty, is rejected for having no words, and its cleaned text is null. Rows
are judged one by one, so repeated rows and null ids change nothing, and an empty table gives an
empty table. Other columns of the input are kept; one named like a result (in any case) is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotally.llm.tables import appended, extended, without
from chronotally.llm.words import line_codes, lines_of, slices, windows, words_of

SEPARATORS = frozenset({b"|", b">", b"<", b"/", b"\xc2\xbb", b"\xc2\xab", b"\xc2\xb7", b"\xe2\x80\xa2", b"-", b"*"})
#: What a line needs for a closer look, in lower case.
_CANDIDATE = re.compile(
    rb"all rights reserved|copyright|licen[sc]ed under|released under|public licen[sc]e"
    rb"|privacy policy|terms of (?:use|service)|cookies|javascript|skip to (?:main )?content|sign in|log ?in to"
    rb"|subscribe to|click here|back to top|share this"
    rb"|rechte vorbehalten|anmelden|klicken|seitenanfang|datenschutz|impressum|abonnieren|lizenz"
    rb"|tous droits r|se connecter|cliquez|retour en haut|mentions l|politique de confidentialit|abonnez|sous licence"
    rb"|derechos reservados|iniciar sesi|haga clic|haz clic|volver arriba|aviso legal|tica de privacidad|suscr|licencia"
)
#: Notices wherever they stand in a line.
_NOTICE = re.compile(
    r"\b(?:all rights reserved|accept (?:all )?cookies|(?:site|page|service|shop|store|app|blog)s? uses? cookies|we use cookies"
    r"|enable javascript|skip to (?:main )?content|agree to (?:our|the|these) (?:terms of (?:use|service)|privacy policy))\b"
    r"|\bcopyright\W{0,2}(?:©|\(c\))|(?:©|\(c\))\W{0,2}copyright\b"
    r"|\b(?:alle rechte vorbehalten|alle cookies akzeptieren|(?:seite|website|webseite) (?:verwendet|nutzt|benutzt) cookies"
    r"|wir (?:verwenden|nutzen|benutzen) cookies|aktivieren sie javascript|javascript aktivieren"
    r"|tous droits réservés|accepter (?:tous )?les cookies|site utilise des cookies|nous utilisons des cookies|activ(?:er|ez) javascript"
    r"|todos los derechos reservados|aceptar (?:todas )?(?:las )?cookies|(?:sitio|sitio web|web|página) (?:usa|utiliza) cookies"
    r"|(?:usamos|utilizamos) cookies|activ(?:ar|e) javascript)\b",
    re.I,
)
#: Phrases of prose as well: they count where they begin a short line or a part of it between separators.
_BEGINS = re.compile(
    r"(?:^|[|•·»/>])\W*(?:(?:please|you (?:must|need to|have to)|(?:this|the) \w+ (?:is|are|was)) )?\b(?:"
    r"sign in(?=\W*$|\s*[^\w\s]|\s+(?:to|with|or|using|now|here|for|again|below)\b)|log ?in to\b|subscribe to\b|click here\b|share this\b"
    r"|back to top\b|privacy policy(?=\W*$|\s*[^\w\s])|terms of (?:use|service)(?=\W*$|\s*[^\w\s])"
    r"|copyright(?=\W*(?:$|\d{4}|by\b|(?-i:[A-Z])))"
    r"|(?:licen[sc]ed|released) under (?:(?:the|a|an) )?(?:(?:cc|cc0|creative commons|[al]?gpl|gnu|mit|bsd|apache|mozilla)\b|[^;]*\blicen[sc]e\b))",
    re.I,
)
#: Entries of menus and prompts in other languages: they count as all of a short line or of a part between separators.
_ENTRY = re.compile(
    r"(?:^|[|•·»/>])\W*(?:"
    r"(?:jetzt )?anmelden|(?:bitte )?melden sie sich an|hier klicken|(?:bitte )?klicken sie hier|(?:zurück )?(?:nach oben|zum seitenanfang)"
    r"|datenschutz(?:erklärung)?|impressum|(?:unseren )?newsletter abonnieren|abonnieren sie unseren newsletter"
    r"|(?:lizenziert|veröffentlicht) unter (?:der |einer )?[^.;]{0,60}\b(?:lizenz|cc|gpl|mit)\b[^;]{0,20}"
    r"|se connecter|connectez-vous(?: pour continuer)?|cliquez ici(?: pour [^.;|]{1,40})?|retour en haut(?: de (?:la )?page)?|mentions légales"
    r"|politique de confidentialité|abonnez-vous(?: à notre (?:lettre d['’]information|newsletter))?"
    r"|(?:publié |distribué )?sous licence (?:cc|creative commons|gnu|[al]?gpl|mit|apache)\b[^;]{0,40}"
    r"|iniciar sesión|inicie sesión(?: para continuar)?|ha(?:ga|z) clic aquí(?: para [^.;|]{1,40})?|volver arriba|aviso legal|política de privacidad"
    r"|suscríb(?:ete|ase) a nuestr[oa] (?:boletín|newsletter)|(?:publicado )?bajo (?:la |una )?licencia (?:cc|creative commons|gnu|[al]?gpl|mit|apache)\b[^;]{0,40}"
    r")\W*(?:$|[|•·»/>])",
    re.I,
)
#: Those that count if they are half of a short line or more, or its end.
_MOST = re.compile(r"\b(?:privacy policy|terms of (?:use|service)|back to top|public licen[sc]e|click here)\b", re.I)
_AT_END = re.compile(r"\bclick here\W*$", re.I)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: Code points of the Unicode property Sentence_Terminal.
_TERMINAL = (
    "21 2e 3f 589 61d-61f 6d4 700-702 7f9 837 839 83d-83e 964-965 104a-104b 1362 1367-1368 166e 1735-1736 17d4-17d5 "
    "1803 1809 1944-1945 1aa8-1aab 1b4e-1b4f 1b5a-1b5b 1b5e-1b5f 1b7d-1b7f 1c3b-1c3c 1c7e-1c7f 2024 203c-203d "
    "2047-2049 2cf9-2cfb 2e2e 2e3c 2e53-2e54 2e60-2e61 3002 a4ff a60e-a60f a6f3 a6f7 a876-a877 a8ce-a8cf a92f "
    "a9c8-a9c9 aa5d-aa5f aaf0-aaf1 abeb fe12 fe15-fe16 fe52 fe56-fe57 ff01 ff0e ff1f ff61 10a56-10a57 10f55-10f59 "
    "10f86-10f89 11047-11048 110be-110c1 11141-11143 111c5-111c6 111cd 111de-111df 11238-11239 1123b-1123c 112a9 "
    "113d4-113d5 1144b-1144c 115c2-115c3 115c9-115d7 11641-11642 1173c-1173e 11944 11946 11a42-11a43 11a9b-11a9c "
    "11c41-11c42 11ef7-11ef8 11f43-11f44 16a6e-16a6f 16af5 16b37-16b38 16b44 16d6e-16d6f 16e98 1bc9f 1da88"
)
_ENDS = re.compile("[;:\u2026" + "".join("-".join(chr(int(c, 16)) for c in r.split("-")) for r in _TERMINAL.split()) + "]")
_ASCII_ENDS = re.compile(rb"[.!?;:]")


@dataclass(frozen=True)
class LineRules:
    """What a line needs to fail: numbers of words, or shares of words or characters."""

    separators: int = 3
    separator_share: float = 0.2
    symbols: int = 5
    symbol_share: float = 0.1
    #: Words from which a line has to end a sentence.
    sentence_words: int = 20
    #: Words up to which a line may be a notice, and up to which a menu entry or prompt.
    notice_words: int = 40
    short_words: int = 12


RULES = LineRules()

COLUMNS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "base_failed": "boolean",
    "lost_words": "bigint",
    "kept": "boolean",
    "cleaned": "string",
}


def boilerplate(line: bytes, n_words: int, rules: LineRules = RULES) -> bool:
    """Whether a line is a notice, a menu entry or a consent banner, and no prose with such words."""
    if n_words > rules.notice_words or not _CANDIDATE.search(line.lower()):
        return False
    text = line.decode(errors="replace")
    if _NOTICE.search(text):
        return True
    if n_words > rules.short_words:
        return False
    most = sum(len(m.group().split()) for m in _MOST.finditer(text))
    return 2 * most >= n_words or any(p.search(text) for p in (_BEGINS, _AT_END, _ENTRY))


def line_fails(line: bytes, rules: LineRules = RULES) -> bool:
    """Whether a line with at least one word breaks a rule."""
    words = line.split()
    symbols = sum(line.count(c) for c in b"#*$%&|<>")
    return (
        (separators := sum(w in SEPARATORS for w in words)) >= rules.separators
        and separators >= rules.separator_share * len(words)
        or symbols >= rules.symbols
        and symbols >= rules.symbol_share * sum(map(len, words))
        or len(words) >= rules.sentence_words
        and not _ASCII_ENDS.search(line)
        and not _ENDS.search(line.decode(errors="replace"))
        or boilerplate(line, len(words), rules)
    )


def repeated(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which entries have an equal key in the same text."""
    order = np.lexsort((keys, text))
    same = (keys[order][1:] == keys[order][:-1]) & (text[order][1:] == text[order][:-1])
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of the base rules for a slice of texts."""
    words = words_of(column)
    n = words.counts()
    begins, text = windows(words.first, 5)
    codes = np.zeros(len(begins), np.uint64)
    for k in range(5):
        codes = codes * np.uint64(0xD1342543DE82EF95) + words.codes[begins + k]
    twice = begins[repeated(codes, text)]
    covered = np.zeros(len(words.starts) + 5, np.int64)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + 5, -1)
    total = np.concatenate(([0], np.cumsum(np.cumsum(covered)[: len(words.starts)] > 0)))

    black = np.zeros(len(words.data) + 1, np.int64)
    black[words.starts] += 1
    np.add.at(black, words.ends, -1)
    in_word = np.cumsum(black)[:-1] > 0
    starts, ends, first = lines_of(words.data, words.offsets)
    has_word = np.searchsorted(words.starts, starts) < np.searchsorted(words.starts, ends)
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))[has_word]
    keys = line_codes(words.data, starts, ends)[has_word]
    order = np.lexsort((keys, of))
    again = (keys[order][1:] == keys[order][:-1]) & (of[order][1:] == of[order][:-1])
    return {
        "n_words": n,
        "word_chars": words.per_text(in_word & ((words.data & 0xC0) != 0x80)),
        "n_symbols": words.per_text(_SYMBOL[words.data]),
        "n_dup_lines": np.bincount(of[order][1:][again], minlength=len(n)),
        "n_repeat_words": total[words.first[1:]] - total[words.first[:-1]],
    }


def _judge(column: pa.Array, max_lost: float, rules: LineRules = RULES) -> dict[str, pa.Array]:
    found = measures(column)
    n, lost, cleaned = found["n_words"], [], []
    for text in column.cast(pa.binary()).to_pylist():
        keep, gone = [], 0
        for line in (text or b"").split(b"\n"):
            if (words := len(line.split())) and line_fails(line, rules):
                gone += words
            else:
                keep.append(line)
        lost.append(gone)
        cleaned.append(None if text is None else b"\n".join(keep))
    failed = (n < 10) | (100 * found["n_repeat_words"] > 20 * n)
    lost = np.array(lost, np.int64)
    return {
        **{k: pa.array(v, pa.int64()) for k, v in found.items()},
        "base_failed": pa.array(failed),
        "lost_words": pa.array(lost),
        "kept": pa.array(~failed & (lost <= max_lost * n)),
        "cleaned": pa.array(cleaned, pa.binary()).view(pa.string()),
    }


def quality(docs: DataFrame, text: str = "text", max_lost: float = 0.5, rules: LineRules = RULES) -> DataFrame:
    """``docs`` with the columns of :data:`COLUMNS`: base counts, the verdict ``kept``, and the
    text without its bad lines (``cleaned``). One pass, no shuffle."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield appended(part, _judge(part.column(text), max_lost, rules))

    docs = without(docs, COLUMNS)
    return docs.mapInArrow(judge, extended(docs, COLUMNS))


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents that pass, with their cleaned text, in the columns of ``docs``."""
    judged = quality(docs, text).filter("kept").withColumn(text, F.col("cleaned"))
    if "n_chars" in docs.columns:
        judged = judged.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    kept = [c for c in docs.columns if c in judged.columns]
    return judged.select(*[F.col(f"`{c}`") for c in kept])
