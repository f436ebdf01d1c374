"""Operator 2: personal data replaced by keyed surrogates.

Entities are found by form: e-mail and IP addresses, telephone, card, account and identity numbers,
secrets (tokens, keys), and names: after a title, after a well-known given name, before a title in
Chinese, and wherever the text repeats a name found so. A surrogate is drawn from a keyed hash of
the entity's normal form, so every mention of one value in the corpus gets one replacement
(coreference, with or without a title, whatever its case or spelling), whoever computes it. It keeps
the type, and of a name the script and the gender that titles in the corpus give it, of a number its
length, separators and check digits, of a text its letter case.

1. Every text is scanned once; what is kept of it are the places of its entities, their keyed
   hashes and their shapes (a script, a number of digits). No value leaves the text in clear.
2. Collision checks: the distinct entities of the whole corpus are brought together; where two would
   share a surrogate, or a surrogate is itself an entity of the corpus, all but the smallest move on
   to their next draw, until none collides. Draws widen, so that short lists don't run out; an
   entity that finds no free surrogate in ``MOST_DRAWS`` draws is an error.
3. Texts that hold entities are joined with their places and rewritten; all others stay as they are.

Not found: names without a title or a well-known given name, and addresses of houses. A name that is
also a common word is replaced only next to a title or another part of a name.

Edge cases: null text stays null, empty stays empty, texts of any length are replaced whole; rows
with a null or repeated doc_id are treated each by its own text. A frame without entities returns
as it was; columns not named here are carried along untouched, whatever their names, but for
``n_replaced``, which is replaced.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import os
import re
import secrets
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.llm.bytewords import slices
from glossmill.llm.frames import IdFilter, cut, fresh

#: Where the key is looked for; without one, each application draws a key of its own.
KEY_SETTING, KEY_VARIABLE = "spark.glossmill.surrogates.key", "GLOSSMILL_SURROGATES_KEY"
#: Draws after which a surrogate takes a wider form, and draws after which there is none.
WIDEN, MOST_DRAWS = 2, 40

# Titles, given names, and names that are common words as well.
_TITLES = {
    "f": "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Sra|Госпожа|Κυρία",
    "m": "Mr|Sir|Herr|Monsieur|Señor|Sr|Господин|Κύριος",
    "": "Dr|Prof|Professor",
}
_HAN_TITLES = {"f": "女士|小姐|太太", "m": "先生"}
_HAN_FAMILY = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何林罗高"
_HAN_GIVEN = {"f": "丽芳娜敏静秀娟英华慧", "m": "伟强军磊勇杰涛明超刚"}
_GIVEN = {
    ("latin", "f"): "Anna Clara Elena Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rita Sara Teresa Vera Wanda".split(),
    ("latin", "m"): "Adam Bruno Carl David Erik Felix Georg Henry Ivan Jonas Kurt Leon Martin Nils Oscar Peter Robert Simon".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Юлия".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Денис Иван Максим Олег Павел Роман Юрий".split(),
}
_FAMILY = {
    "latin": "Abel Becker Carson Dalton Egger Farrow Gibson Hartley Ibsen Jarvis Keller Lawson Marlow Norton Osborn Palmer Quincy Ramsey Sawyer Thorne Ulrich Vernon Walker Yates Zeller".split(),
    "cyrillic": "Белов Громов Зайцев Киселёв Лебедев Морозов Новиков Орлов Павлов Соколов Тихонов Шубин".split(),
}
_WELL_KNOWN = {
    "f": (
        "Amanda Amy Angela Barbara Betty Carmen Carolyn Catherine Christine Cynthia Deborah Donna Dorothy Elizabeth Emily Emma Janet Jennifer Jessica Karen"
        " Katherine Kathleen Kimberly Linda Lisa Margaret Marie Mary Melissa Michelle Monika Nancy Nicole Pamela Patricia Petra Rachel Rebecca Sabine Samantha"
        " Sandra Sarah Sharon Shirley Sophie Stephanie Susan Ursula"
    ).split(),
    "m": (
        "Alexander Andrew Anthony Benjamin Brian Carlos Charles Christopher Daniel Dennis Donald Edward Eric Gary George Gregory Hans James Jason Jeffrey"
        " John Jonathan Joseph Joshua José Juan Jürgen Kenneth Kevin Klaus Larry Luis Matthew Michael Nicholas Patrick Paul Pierre Raymond Richard Ronald Ryan"
        " Samuel Scott Stefan Stephen Steven Thomas Timothy William Wolfgang"
    ).split(),
}
_COMMON = set(
    "baker banks bell best bishop black brown bush butler church cook day field fields fisher fox grace green grey gray hall hill hope hunt hunter king knight lake lane"
    " law little long love marsh mason may miller moon moore new north page park parker pope price rice rich rivers rose sharp short small snow stone summer taylor"
    " trust turner wall ward water waters way weaver west white winter wise wolf wood woods young gross klein lang neu schwarz weiss petit grand".split()
)
_NOT_FAMILY = set("the a an and or of in on at to for with from is was are der die das und le la les el los las et y".split())

SALTS = 16

_GENDER = {form: g for g, ts in _TITLES.items() for t in ts.split("|") for form in (t, t.upper())}
# The s of a possessive is no part of a name.
_WORD = r"(?:[OD]['’])?[^\W\d_a-zß-öø-ÿ][^\W\d_]+(?:[-'’](?![sS]\b)[^\W\d_]+)?"
_TITLED = re.compile(rf"(?:{'|'.join(sorted(_GENDER, key=len, reverse=True))})\b\.?\s{{1,3}}(?P<person>{_WORD}(?:[\u00a0 ]{_WORD}){{0,2}})")


def _folded(word: str) -> str:
    """A name without case and, in Latin script, without accents."""
    plain = unicodedata.normalize("NFKD", word)
    return ("".join(c for c in plain if not unicodedata.combining(c)) if plain[:1].isascii() else word).casefold()


_LISTED = {g: {*_WELL_KNOWN[g], *_GIVEN["latin", g], *_GIVEN["cyrillic", g]} for g in "fm"}
_GENDER_OF = {_folded(w): g for g, ws in _LISTED.items() for w in ws}
_KNOWN_GIVEN = frozenset(_GENDER_OF)
_FORMS = {form for ws in _LISTED.values() for w in ws for form in (w, "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)) if w[0].isascii() else w)}
_UNTITLED = re.compile(rf"(?P<given>{'|'.join(sorted(_FORMS, key=lambda w: (-len(w), w)))})[\u00a0 ](?P<family>{_WORD})")
_HAN_TITLED = re.compile(rf"(?P<name>[{_HAN_FAMILY}][一-鿿]{{0,2}}?)(?P<title>{'|'.join(_HAN_TITLES.values())})")
_SECRET = re.compile(r"sk-[A-Za-z0-9]{20,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|(?=[0-9A-Fa-f]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}(?![0-9A-Za-z])")
_IBAN = re.compile(r"[A-Z][A-Z](?<![0-9A-Za-z]..)\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_SSN_AFTER = re.compile(r"SSN\b\D{0,3}(\d{3}[ -]?\d{2}[ -]?\d{4})(?!\d)")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NUMBER = re.compile(
    rf"(?P<ip>(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d))"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<nanp>\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|\d{3}[.-]\d{3}[.-]\d{4}(?!\d))"
    r"|(?P<abroad>(?:\+|00(?=[1-9]))\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d+){1,6})"
    r"|(?P<card>\d(?:[ -]?\d){12,18}(?!\d))"
    r"|(?P<home>0[1-9]\d{1,4}[ /-]\d{5,9}(?!\d))"
)
_NUMBER_START = re.compile(r"[0-9]+|[+(]")
_HEX = re.compile("[0-9A-Fa-f]{32,}")
_SYLLABLES = [a + b for a in "bdfgklmnprstv" for b in "aeiou"]
_CYRILLIC_SYLLABLES = [a + b for a in "бвгдклмнпрст" for b in "аеио"]
# Country calling codes of one and of two digits; all others have three.
_CODES = {"1", "7", "20", "27", *(str(n) for a, b in ((30, 34), (36, 36), (39, 41), (43, 49), (51, 58), (60, 66), (81, 82), (84, 84), (86, 86), (90, 95), (98, 98)) for n in range(a, b + 1))}


def key_of(spark: SparkSession) -> bytes:
    """The configured key, or one drawn for this application."""
    given = spark.conf.get(KEY_SETTING, None) or os.environ.get(KEY_VARIABLE)
    return given.encode() if given else _drawn_key(spark.sparkContext.applicationId)


@lru_cache(maxsize=4)
def _drawn_key(application: str) -> bytes:
    return secrets.token_bytes(32)


# --- what stands in a text ------------------------------------------------------------------------


def _script(word: str) -> str:
    return unicodedata.name(word[0], "LATIN").split()[0].lower()


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


#: Before four numbers that are no address.
_VERSION = re.compile(r"(?i)(?<![a-z])(?:v|ver|versions?|release|build|rev)[. ]{0,2}\Z")


def _left_is_free(text: str, kind: str, a: int) -> bool:
    before = text[a - 1 : a]
    if not before:
        return True
    if kind == "ip":
        return not (before.isdigit() or before == "." or _VERSION.search(text, max(0, a - 12), a))
    if kind in ("card", "ssn"):
        return not (before.isdigit() or before == "-")
    return not (before.isalnum() or before in "_+(.-")


def _numbers(text: str):
    done = 0
    for start in _NUMBER_START.finditer(text):
        a = start.start()
        m = _NUMBER.match(text, a) if a >= done else None
        if not m or not _left_is_free(text, m.lastgroup, a):
            continue
        kind, b = m.lastgroup, m.end()
        if kind == "abroad":
            digits = sum(c.isdigit() for c in m[0])
            while digits > 15 + 2 * (m[0][0] == "0"):  # what follows is another number
                cut_at = max(text.rfind(s, a, b) for s in " .-")
                if cut_at <= a:
                    break
                digits -= sum(c.isdigit() for c in text[cut_at:b])
                b = cut_at
            if not 8 <= digits <= 17:
                continue
        done = b
        yield a, b, "phone" if kind in ("nanp", "abroad", "home") else kind


def _sixes(text: str):
    """IPv6 addresses: runs of hexadecimal digits and colons that are one."""
    at = 0
    while (colon := text.find(":", at)) >= 0:
        a, b = colon, colon + 1
        while a and (text[a - 1] in "0123456789abcdefABCDEF:"):
            a -= 1
        while b < len(text) and text[b] in "0123456789abcdefABCDEF:":
            b += 1
        at = b
        if b - a >= 7 and text.count(":", a, b) >= 3 and any(c.isdigit() for c in text[a:b]) and not text[a - 1 : a].isalnum() and not text[b : b + 1].isalnum():
            b -= text[a:b].endswith(":") and not text[a:b].endswith("::")
            try:
                ipaddress.IPv6Address(text[a:b])
            except ValueError:
                continue
            yield a, b, "ip6"


def _emails(text: str):
    at = text.find("@")
    while at >= 0:
        a = at
        while a and (text[a - 1].isalnum() or text[a - 1] in "_.+-"):
            a -= 1
        while a < at and not (text[a].isascii() and text[a].isalnum()):
            a += 1
        domain = _DOMAIN.match(text, at + 1)
        if a < at and domain:
            yield a, domain.end(), "email"
        at = text.find("@", at + 1)


def _person(text: str, a: int, b: int, shouted: bool) -> list[tuple[int, int, str]]:
    """Spans of the words of a name, the last a family name."""
    words = []
    for m in re.finditer(r"[^\u00a0 ]+", text[a:b]):
        if m[0][0].islower() or words and m[0].casefold() in _NOT_FAMILY:
            break
        words.append((a + m.start(), a + m.end()))
    if shouted:  # the rest may be capitals as well, and no name
        words = words[: 2 if len(words) > 1 and _folded(text[slice(*words[0])]) in _KNOWN_GIVEN else 1]
    return [(x, y, f"{'family' if i == len(words) - 1 else 'given'}:{_script(text[x:y])}") for i, (x, y) in enumerate(words)]


def spans(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, gender) of what is replaced in a text, in order and without overlaps.

    gender: f or m where a title tells, or a well-known given name, else ''.
    """
    if not text:
        return []
    out: list[tuple[int, int, str, str]] = []
    taken: bytearray | None = None

    def take(found) -> None:
        nonlocal taken
        for a, b, kind, *gender in found:
            if taken is None:
                taken = bytearray(len(text))
            if b > a and not any(taken[a:b]):
                taken[a:b] = b"\x01" * (b - a)
                out.append((a, b, kind, gender[0] if gender else ""))

    if "@" in text:
        take(_emails(text))
    if any(len(w) >= 20 for w in text.split()):
        take((m.start(), m.end(), "secret") for m in _SECRET.finditer(text) if not text[m.start() - 1 : m.start()].isalnum())
    take((m.start(), m.end(), "iban") for m in _IBAN.finditer(text))
    if ":" in text:
        take(_sixes(text))
    if "SSN" in text:
        take((m.start(1), m.end(1), "ssn") for m in _SSN_AFTER.finditer(text))
    take(_numbers(text))
    names: dict[str, str] = {}  # as written: kind
    for pattern in (_TITLED, _UNTITLED):
        for m in pattern.finditer(text):
            if text[m.start() - 1 : m.start()].isalnum() or text[m.start() - 1 : m.start()] == "_":
                continue
            if pattern is _TITLED:
                title = re.match(r"\w+", m[0])[0]
                parts = [(*p, _GENDER[title]) for p in _person(text, *m.span("person"), title.isupper())]
            elif m["family"].casefold() in _NOT_FAMILY or m["family"][0].islower():
                continue
            else:
                parts = [(*m.span("given"), f"given:{_script(m['given'])}", _GENDER_OF[_folded(m["given"])]), (*m.span("family"), f"family:{_script(m['family'])}", "")]
            take(parts)
            names |= {text[a:b]: kind for a, b, kind, _ in parts}
    for m in _HAN_TITLED.finditer(text) if "先" in text or "女" in text or "小" in text or "太" in text else ():
        take([(*m.span("name"), "full:cjk", "m" if m["title"] in _HAN_TITLES["m"] else "f")])
        if len(m["name"]) > 1:
            names[m["name"]] = "full:cjk"
    if names:  # the same people again
        every = {form: kind for name, kind in names.items() for form in (name, name.upper())}
        again = re.compile("|".join(map(re.escape, sorted(every, key=len, reverse=True))))
        edges = {b + 1 for a, b, k, _ in out if k.startswith(("given", "family"))}
        for m in again.finditer(text):
            a, b, kind = m.start(), m.end(), every[m[0]]
            if kind != "full:cjk" and (text[a - 1 : a].isalnum() or text[b : b + 1].isalnum() or text[a - 1 : a] in ("-", "_") or text[b : b + 1] in ("-", "_")):
                continue
            if m[0].casefold() in _COMMON and a not in edges:
                continue
            take([(a, b, kind)])
            edges.add(b + 1)
    return sorted(out)


def normal(kind: str, text: str) -> str:
    """What all mentions of one value have in common."""
    if kind.startswith(("given", "family", "full")):
        word = _folded(text)
        return word[:-1] if kind == "family:cyrillic" and word.endswith(("ова", "ева", "ёва", "ина", "ына")) else word
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip6":
        return ipaddress.IPv6Address(text).exploded
    if kind == "phone":
        digits = re.sub(r"\D", "", text)
        if text.startswith("+"):
            return digits
        if text.startswith("00"):
            return digits[2:]
        return digits if digits.startswith("0") else f"1{digits}"  # the form (ddd) ddd-dddd is North American
    if kind == "email" or kind == "secret" and _HEX.fullmatch(text):
        return text.lower()
    return text


def _country(digits: str) -> str:
    return next((digits[:n] for n in (1, 2) if digits[:n] in _CODES), digits[: 1 if digits.startswith("0") else 3])


def _iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def shape(kind: str, value: str) -> str:
    """What a surrogate keeps of a normal form; tells nothing of who it is."""
    if kind.startswith(("given", "family", "full")):
        return "" if kind.endswith((":latin", ":cyrillic")) else str(len(value))
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        return re.sub(r"\d", "0", re.sub(r"[^\W\d_]", "a", local)) + "@" + ".".join(labels[-2:] if len(labels) > 2 else labels[-1:])
    if kind == "ip":
        a, b = map(int, value.split(".")[:2])
        inner = a in (10, 127) or (a, b) in ((192, 168), (169, 254)) or a == 172 and 16 <= b < 32
        return f"{a}.{b}" if inner else ""
    if kind == "ip6":
        return value[:4] if value.startswith(("fe8", "fc", "fd")) else "2001:0db8"
    if kind == "card":
        return f"{value[0]}:{len(value)}:{int(_luhn(value) == 0)}"
    if kind == "iban":
        return value[:2] + re.sub("[A-Z]", "A", re.sub(r"\d", "0", value[4:])) + f":{int(_iban_rest(value) == 1)}"
    if kind == "phone":
        country = _country(value)
        at = value.find("555", max(len(country), len(value) - 7))
        return f"{country}:{len(value)}:{at}"
    if kind == "ssn":
        return str(len(value))
    head = re.match(r"sk-|AKIA|gh[pousr]_", value)
    if head:
        return head[0] + ":" + re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "0", value[head.end() :])))
    return f"hex:{len(value)}"


# --- surrogates -----------------------------------------------------------------------------------


def identity(kind: str, value: str, key: bytes) -> str:
    """The keyed hash that stands for a value. Parts of names share one space."""
    space = "name" if kind.startswith(("given", "family", "full")) else kind
    return hmac.new(key, f"{space}\x00{value}".encode(), hashlib.sha256).hexdigest()[:32]


class Draw:
    """Numbers from the keyed hash of what is replaced and from how often it had to move on."""

    def __init__(self, who: str, key: bytes, attempt: int) -> None:
        self._seed = hmac.new(key, f"{attempt}\x00{who}".encode(), hashlib.sha256).digest()
        self._n, self._pool = 0, 0

    def below(self, n: int) -> int:
        if self._pool < 1 << 64:
            self._pool = int.from_bytes(hashlib.sha256(self._seed + self._n.to_bytes(4, "big")).digest(), "big")
            self._n += 1
        self._pool, out = divmod(self._pool, n)
        return out

    def of(self, options):
        return options[self.below(len(options))]

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))

    def like(self, pattern: str) -> str:
        """A digit for each 0, a letter for each a and A."""
        return "".join(str(self.below(10)) if c == "0" else self.of("abcdefghijklmnopqrstuvwxyz") if c == "a" else self.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c == "A" else c for c in pattern)


@lru_cache(maxsize=64)
def _letters(script: str) -> str:
    """The plain letters of a script, lower case where it has cases."""
    kinds = re.compile(rf"{re.escape(script.upper())} (?:SMALL LETTER|LETTER|SYLLABLE) [A-Z]+")
    runs = [[]]
    for code in range(0x80, 0x10000):  # the longest run leaves archaic letters out
        if kinds.fullmatch(unicodedata.name(chr(code), "")):
            if runs[-1] and code - ord(runs[-1][-1]) > 2:
                runs.append([])
            runs[-1].append(chr(code))
    return "".join(max(runs, key=len)) or "abcdefghijklmnopqrstuvwxyz"


def _name(role: str, script: str, gender: str, shape: str, draw: Draw, attempt: int) -> str:
    more = 0 if attempt < WIDEN else 2 + attempt // WIDEN
    if script in ("latin", "cyrillic"):
        name = draw.of(_GIVEN[script, gender or draw.of("fm")] if role == "given" else _FAMILY[script])
        tail = "".join(draw.of(_SYLLABLES if script == "latin" else _CYRILLIC_SYLLABLES) for _ in range(more)).title()
        if not tail:
            return name
        return f"{name}-{tail}" if role == "given" or script == "latin" else f"{tail}-{name}"  # the ending of a family name stays
    n = int(shape)
    if script == "cjk":
        given = _HAN_GIVEN[gender] if gender else _HAN_GIVEN["f"] + _HAN_GIVEN["m"]
        return draw.of(_HAN_FAMILY) + "".join(draw.of(given) for _ in range(max(1, n - 1) + more // 2))
    word = "".join(draw.of(_letters(script)) for _ in range(max(3, n) + more))
    return word[0].upper() + word[1:]


def surrogate(kind: str, who: str, shape: str, gender: str, attempt: int, key: bytes) -> str:
    """The replacement of an identity, in normal form."""
    draw = Draw(who, key, attempt)
    wide = attempt >= WIDEN
    if kind.startswith(("given", "family", "full")):
        role, _, script = kind.partition(":")
        return _name(role, script, gender, shape, draw, attempt)
    if kind == "email":
        local, _, suffix = shape.partition("@")
        new = re.sub("a+", lambda m: ("".join(draw.of(_SYLLABLES) for _ in range(1 + len(m[0]) // 2)))[: max(2, len(m[0]))], local)
        new = re.sub("0", lambda _: str(draw.below(10)), new)
        return f"{new}{draw.digits(4 if not wide else 8)}@{''.join(draw.of(_SYLLABLES) for _ in range(3))}.{suffix}"
    if kind == "ip":
        if shape:  # of the same kind of network, of another one where that is full
            head = shape if not wide or shape.startswith(("127", "169")) and attempt < 4 * WIDEN else f"10.{draw.below(256)}"
        else:
            head = f"{draw.of([*range(11, 100), *range(128, 169), *range(193, 223)])}.{draw.below(256)}"
        return f"{head}.{draw.below(256)}.{1 + draw.below(254)}"
    if kind == "ip6":
        left = 8 - 1 - shape.count(":")
        return ":".join([shape, *(f"{draw.below(1 << 16):04x}" for _ in range(left))])
    if kind == "card":
        first, n, valid = shape.split(":")
        digits = first + draw.digits(int(n) - 1)
        off = 0 if valid == "1" else 1 + draw.below(9)
        return digits[:-1] + str((off - _luhn(digits[:-1] + "0")) % 10)
    if kind == "iban":
        rest, valid = shape[2:].split(":")
        account = draw.like(rest)
        check = 98 - _iban_rest(f"{shape[:2]}00{account}")
        if valid == "0":
            check = 2 + (check - 2 + 1 + draw.below(96)) % 97
        return f"{shape[:2]}{check:02d}{account}"
    if kind == "phone":
        country, n, at = shape.split(":")
        # A number within a country begins with one zero: two would begin one of another country.
        digits = country + draw.digits(int(n) - len(country)) if country != "0" else f"0{1 + draw.below(9)}{draw.digits(int(n) - 2)}"
        return digits if at == "-1" or wide else digits[: int(at)] + "555" + digits[int(at) + 3 :]  # 555 is set aside for fiction
    if kind == "ssn":
        return draw.digits(int(shape))
    head, _, form = shape.partition(":")
    if head == "hex":
        return "a" + "".join(draw.of("0123456789abcdef") for _ in range(int(form) - 2)) + str(draw.below(10))
    return head + draw.like(form)


def written(kind: str, new: str, old: str) -> str:
    """A surrogate in the form of the mention that it replaces."""
    if kind in ("card", "ssn", "phone"):
        if kind == "phone":
            new = f"00{new}" if old.startswith("00") else new if old.startswith(("+", "0", "(0")) else new[1:]
        it = iter(new)
        return re.sub(r"\d", lambda _: next(it), old)
    if kind == "iban":
        it = iter(new)
        return "".join(c if c == " " else next(it, "") for c in old)
    if kind == "ip6":
        return ipaddress.IPv6Address(new).compressed if len(old) < 39 else new
    if kind == "family:cyrillic" and old.casefold().endswith(("ова", "ева", "ёва", "ина", "ына")):
        new += "а"
    if (kind in ("email", "secret") and (kind == "email" or _HEX.fullmatch(old)) or kind.startswith(("given", "family"))) and old.isupper():
        return new.upper()
    return new


def rewritten(text: str, places: list[tuple[int, int, str]], known: dict[tuple[str, str], tuple[int, str]], key: bytes) -> str:
    """The text with surrogates in its places. known: attempt and gender of (kind, identity)."""
    out, at = [], 0
    for a, b, kind in places:
        value = normal(kind, text[a:b])
        who = identity(kind, value, key)
        attempt, gender = known.get((kind, who), (0, ""))
        out += [text[at:a], written(kind, surrogate(kind, who, shape(kind, value), gender, attempt, key), text[a:b])]
        at = b
    return "".join(out) + text[at:]


def replaced(text: str | None, known: dict[tuple[str, str], tuple[int, str]], key: bytes) -> tuple[str | None, int]:
    """The text with surrogates, and how many mentions were replaced. Names not in ``known`` take
    the gender that their titles in this text give them."""
    found = spans(text)
    told: dict[tuple[str, str], set] = {}
    for a, b, kind, gender in found:
        told.setdefault((kind, identity(kind, normal(kind, text[a:b]), key)), set()).add(gender)
    known = {who: (0, *(genders - {""})) for who, genders in told.items() if len(genders - {""}) == 1} | known
    return (rewritten(text, [s[:3] for s in found], known, key), len(found)) if found else (text, 0)


def entities(text: str | None) -> list[tuple[str, str]]:
    """(kind, normal form) of every mention in a text."""
    return [(kind, normal(kind, text[a:b])) for a, b, kind, _ in spans(text)]


# --- over a corpus --------------------------------------------------------------------------------


def assignments(taken: DataFrame, key: bytes) -> DataFrame:
    """kind, who, gender, attempt of every distinct entity, no surrogate twice.

    taken: kind, who, shape, gender, one row an entity.
    """

    def draw(batches):
        for batch in batches:
            kinds, whos, shapes, genders, attempts = (c.to_pylist() for c in batch.columns)
            if max(attempts, default=0) > MOST_DRAWS:
                raise ValueError(f"no free surrogate of kind {kinds[0]} in {MOST_DRAWS} draws")
            new = [identity(k, normal(k, surrogate(k, w, s, g, a, key)), key) for k, w, s, g, a in zip(kinds, whos, shapes, genders, attempts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*batch.schema.names, "new"])

    schema = "kind string, who string, shape string, gender string, attempt int, new string"
    drawn = cut(taken.select("kind", "who", "shape", "gender", F.lit(0).alias("attempt")).mapInArrow(draw, schema))
    # Identities of names of any part share a space, those of other kinds have one each.
    real = taken.select(F.col("who").alias("new"), F.lit(True).alias("is_real")).distinct()
    while True:
        first = drawn.groupBy("new").agg(F.min(F.struct("kind", "who")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        marked = drawn.join(first, "new", "left").join(real, "new", "left")
        moves = F.coalesce(F.col("first") != F.struct("kind", "who"), F.lit(False)) | F.col("is_real").isNotNull()
        marked = cut(marked.select("kind", "who", "shape", "gender", "attempt", "new", moves.alias("moves")))
        if marked.where("moves").isEmpty():
            return drawn.drop("new", "shape")
        again = marked.where("moves").select("kind", "who", "shape", "gender", (F.col("attempt") + 1).alias("attempt")).mapInArrow(draw, schema)
        drawn = cut(marked.where("NOT moves").drop("moves").unionByName(again))


def surrogates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: bytes | None = None) -> DataFrame:
    """The rows of ``docs`` with ``text`` replaced, and ``n_replaced``."""
    docs = docs.drop("n_replaced")
    key = key_of(docs.sparkSession) if key is None else key

    def find(batches):
        for batch in batches:
            for part in slices(batch, 2):
                rows = []
                for at, check, value in zip(*(c.to_pylist() for c in part.columns)):
                    found = spans(value)
                    if found:
                        held = {}
                        for a, b, kind, gender in found:
                            plain = normal(kind, value[a:b])
                            held.setdefault((kind, identity(kind, plain, key), shape(kind, plain)), set()).add(gender)
                        listed = [{"kind": k, "who": w, "shape": s, "f": "f" in g, "m": "m" in g} for (k, w, s), g in held.items()]
                        rows.append((at, check, [{"a": a, "b": b, "kind": kind} for a, b, kind, _ in found], listed))
                columns = list(zip(*rows)) or [()] * 4
                kinds = (pa.int64(), pa.int64(), pa.list_(place), pa.list_(entity))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["at", "check", "places", "held"])

    place = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("kind", pa.string())])
    entity = pa.struct([("kind", pa.string()), ("who", pa.string()), ("shape", pa.string()), ("f", pa.bool_()), ("m", pa.bool_())])
    found_as = "at long, check long, places array<struct<a:int,b:int,kind:string>>, held array<struct<kind:string,who:string,shape:string,f:boolean,m:boolean>>"
    # Rows are told apart by what they say, with 128 bits; equal rows have equal places.
    marks = F.xxhash64(F.col(doc_id), F.col(text)), F.xxhash64(F.col(text), F.lit(7), F.col(doc_id))
    found = docs.select(marks[0].alias("at"), marks[1].alias("check"), F.col(text).cast("string").alias("text")).mapInArrow(find, found_as)
    found = cut(found.dropDuplicates(["at", "check"]))

    each = found.select("at", "check", F.explode("held").alias("e")).select("at", "check", "e.*")
    gender = F.when(F.bool_or("f") & ~F.bool_or("m"), "f").when(F.bool_or("m") & ~F.bool_or("f"), "m").otherwise("")
    taken = cut(each.groupBy("kind", "who").agg(F.min("shape").alias("shape"), gender.alias("gender")))
    known = assignments(taken, key).where("attempt > 0 OR gender <> ''")
    # One entity may stand in a third of the texts: its mentions are dealt to SALTS keys.
    spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    listed = each.withColumn("salt", F.pmod("at", F.lit(SALTS)).cast("int")).join(spread, ["kind", "who", "salt"]).groupBy("at", "check").agg(F.collect_list(F.struct("kind", "who", "attempt", "gender")).alias("known"))
    work = found.select("at", "check", "places").join(listed, ["at", "check"], "left")

    names = docs.columns
    own = [fresh(n, names) for n in ("at", "check", "places", "known")]
    marked = docs.withColumns({own[0]: marks[0], own[1]: marks[1]})
    among = IdFilter(found.select(F.col("at").alias(own[0])), own[0])
    may = among.passing(marked).join(work.toDF(*own), own[:2], "left").select(*names, *own[2:])
    where = names.index(text)
    schema = ", ".join(f"`{c}` {kind}" for c, kind in docs.dtypes) + ", n_replaced long"

    def swap(batches):
        for batch in batches:
            for part in slices(batch, where):
                texts, places, lists = (part.column(i).to_pylist() for i in (where, len(names), len(names) + 1))
                new = [
                    rewritten(t, [(p["a"], p["b"], p["kind"]) for p in ps], {(e["kind"], e["who"]): (e["attempt"], e["gender"]) for e in ls or ()}, key) if ps else t
                    for t, ps, ls in zip(texts, places, lists)
                ]
                columns = list(part.columns[: len(names)])
                columns[where] = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array([len(ps or ()) for ps in places], pa.int64())], [*names, "n_replaced"])

    return may.mapInArrow(swap, schema).unionByName(among.passing(marked, inside=False).select(*names, F.lit(0).cast("long").alias("n_replaced")))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return surrogates(docs).select("doc_id", "text", "n_replaced")
