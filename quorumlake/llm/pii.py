"""PII surrogates: keyed replacements of the same type, gender, script and format.

E-mail addresses, phone, card and account numbers, social security numbers, IP addresses and secrets are
mapped by a keyed permutation (a Feistel network with cycle walking) of all values of the same format: each
letter stays a letter of its case, each digit a digit, the rest as it is; a card keeps its issuer digit and
whether its check digit holds. A permutation cannot merge two entities, and equal entities map alike in
every document. Personal names, found by titles or listed given names, are drawn by a keyed hash
from composed names of their role, script and gender, some billions each. What can collide
(names, secrets of different alphabets) goes through a collision check; the later one of two that met is drawn again
from a larger space until none meet.

Scale: the texts pass twice through narrow maps, to check and to replace. The check shuffles keyed hashes of
entities and of their surrogates, summed up by partition first; no personal value leaves its row, and nothing is staged. n distinct
names of a kind meet some n^2 / 10^10 times; only those exceptions, up to ``MOST_AGAIN``, reach the driver. Where more would meet,
all names are drawn from a larger space instead, one syllable longer, in which some 700 times fewer do.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- lists

#: Titles before a name and the gender they tell (fixed values).
TITLES = {
    "m": "Mr Herr Hr Monsieur M Señor Sr Don г-н господин Κύριος 先生".split(),
    "f": "Mrs Ms Miss Frau Fr Madame Mme Mademoiselle Mlle Señora Sra Señorita Srta Doña г-жа госпожа Κυρία 女士".split(),
    "": "Dr Prof Professor Doctor".split(),
}
#: Given names that tell a gender and, before a capitalised word, a person.
GIVEN = {
    ("latin", "m"): "Adam Albert Anton Arthur Bruno Carl Daniel David Emil Eric Felix Frank Gabriel George Henry Hugo Ivan James Jonas Julian Leon Louis Lucas Marco Martin Max Michael Oliver Oscar Paul Peter Philip Robert Samuel Simon Theo Thomas Victor Walter William".split(),
    ("latin", "f"): "Alice Anna Astrid Barbara Clara Carla Caroline Diana Elena Elisa Emma Eva Flora Gloria Hannah Helena Ida Irene Julia Karin Laura Lena Lisa Lucia Maria Marta Mia Nina Nora Olga Paula Rita Rosa Sara Silvia Sofia Teresa Vera Victoria Zoe".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Григорий Дмитрий Иван Кирилл Максим Николай Олег Павел Роман Сергей Юрий".split(),
    ("cyrillic", "f"): "Алла Анна Валентина Вера Галина Дарья Елена Ирина Ксения Людмила Мария Наталья Ольга Светлана Татьяна".split(),
    ("greek", "m"): "Αλέξανδρος Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Παύλος Πέτρος Σπύρος Στέφανος".split(),
    ("greek", "f"): "Άννα Βασιλική Ελένη Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα Δέσποινα Αγγελική".split(),
    ("han", "m"): "伟 强 军 勇 杰 涛 明 超 刚 平".split(),
    ("han", "f"): "芳 娜 敏 静 丽 艳 娟 霞 秀 玲".split(),
}
#: Parts of composed names by script: first, second and third letters of a syllable, and the ends of family names and
#: of given names by gender.
SYLLABLES = {
    "latin": ("b br d dr f fl g gr h j k kl l m n p pr r s st t tr v w".split(), "a e i o u".split(), ["", "l", "m", "n", "r", "s"]),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у".split(), ["", "л", "м", "н", "р", "с"]),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ".split(), "α ε η ι ο".split(), ["", "λ", "μ", "ν", "ρ", "σ"]),
}
ENDS = {
    ("latin", "family"): "bach berg burg dale feld ford hof holm ler lund mann ner sen son stein tal ton well wood worth".split(),
    ("latin", "m"): "ald an ard el er ert ik in is o on us".split(),
    ("latin", "f"): "a ana ella elle ena etta ia ie ina ine isa ora".split(),
    ("cyrillic", "family"): "ов ев ин".split(),
    ("cyrillic", "m"): "ан ей ий ил ис ор".split(),
    ("cyrillic", "f"): "ана ена ина ира ия ея".split(),
    ("greek", "family"): "άκης άτος ίδης ίου όπουλος".split(),
    ("greek", "m"): "ας ης ος".split(),
    ("greek", "f"): "α η ω".split(),
}
#: Chinese family names, a closed list, and the ends of given names by gender (those of GIVEN).
HAN_FAMILY = "王 李 张 刘 陈 杨 黄 赵 吴 周".split()
HAN = 0x4E00, 20902
#: Letters of initials.
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "han": "abcdefghijklmnopqrstuvwxyz"}
#: Feminine and base ends of Russian family names (fixed values).
FEMININE = (("ова", "ов"), ("ева", "ев"), ("ёва", "ёв"), ("ина", "ин"), ("ына", "ын"))
_GENDER = {n.lower(): g for (_, g), names in GIVEN.items() for n in names}

# ---------------------------------------------------------------- detection

_UPPER = "A-ZÀ-ÖØ-ÞА-ЯЁΑ-Ω"
_NAME = rf"(?:[{_UPPER}]['’])?[^\W\d_]*[{_UPPER}][^\W\d_]+(?:-(?:[{_UPPER}]['’])?[{_UPPER}][^\W\d_]+)?"
#: What may stand before a name: initials, and particles (fixed values), which stay.
_PARTICLES = "da de del della den der des di do dos du la las le los ten ter van vom von zu zum zur".split()
_LINK = rf"(?:[{_UPPER}]\.[ \u00a0-]?){{0,3}}(?:(?:{'|'.join(_PARTICLES)})[ \u00a0]+){{0,3}}"
_TITLE = "|".join(sorted((re.escape(t) for g in TITLES.values() for t in g if not "一" <= t[0] <= "鿿"), key=len, reverse=True))
_KNOWN = "|".join(sorted((n for (script, _), names in GIVEN.items() if script != "han" for n in names), key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9À-ÖØ-öø-ÿ](?:[A-Za-z0-9À-ÖØ-öø-ÿ._%+-]*[A-Za-z0-9À-ÖØ-öø-ÿ_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}"),
    "secret": re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|credential)s?[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9+/_.~-]{8,}={0,2})|(?<![A-Za-z0-9])((?:AKIA|ghp_|sk-|xox[abp]-)[A-Za-z0-9_-]{12,}|[0-9a-f]{32,64})(?![A-Za-z0-9])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![\d.-])[2-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\d-]|\.\d)"),
    "ipv4": re.compile(rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\d]|\.\d)"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "phone": re.compile(
        r"(?<![\w.+-])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}|0\d(?:[ .-]\d{2}){4}|[6-9]\d{1,2} \d{3} \d{2} \d{2}|1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}"
        r"|\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6})(?![\d-]|\.\d)|(?<![\w.])\+\d{7,15}(?!\d)"
    ),
    "person": re.compile(rf"(?<!\w)({_TITLE})\.?\s+({_LINK}{_NAME}(?:\s+{_LINK}{_NAME}){{0,2}})|(王|李|张|刘|陈|杨|黄|赵|吴|周)([一-鿿]{{1,2}})(先生|女士)"),
    "named": re.compile(rf"(?<![\w-])(?:{_KNOWN})(?:[ \u00a0]+{_LINK}{_NAME}){{1,2}}(?![\w-])"),
}
_DIGIT = re.compile(r"\d")
#: What a text must contain for a pattern to be tried: cheap searches that spare most texts the patterns. Each is a
#: necessary condition of its pattern.
_KEYWORDS = ("token", "secret", "passw", "key", "credential")
_PREFIXES = ("akia", "ghp_", "sk-", "xox")
_HEX_LETTERS = re.compile("[a-fA-F]{32}")
_TITLE_CUES = tuple(t for g in TITLES.values() for t in g if not "一" <= t[0] <= "鿿")
_GIVEN_CUE = re.compile(_KNOWN)
_HAN_CUES = ("先生", "女士")


def _folded(text: str) -> str:
    """Lower case, with the letters that a pattern without case takes for i and s (lower() maps the sign K itself)."""
    return text.replace("İ", "i").replace("ı", "i").replace("ſ", "s").lower()


def _titled(text: str) -> bool:
    """Whether a title stands at a word's start and before a dot or any white space."""
    for t in _TITLE_CUES:
        at = text.find(t)
        while at >= 0:
            after = text[at + len(t) : at + len(t) + 1]
            if (after == "." or after.isspace()) and not (at and (text[at - 1].isalnum() or text[at - 1] == "_")):
                return True
            at = text.find(t, at + 1)
    return any(t in text for t in _HAN_CUES)


def _secretive(text: str) -> bool:
    """Whether a text without digits may hold a secret."""
    low = _folded(text)
    return ("=" in low or ":" in low) and any(k in low for k in _KEYWORDS) or any(k in low for k in _PREFIXES) or bool(_HEX_LETTERS.search(text))


def _worth(text: str) -> set[str]:
    """Types whose pattern may match."""
    kinds = {"email"} if "@" in text else set()
    if _GIVEN_CUE.search(text):
        kinds.add("named")
    if _DIGIT.search(text):
        kinds |= {"secret", "iban", "card", "ipv4", "ssn", "phone"}
    elif _secretive(text):
        kinds.add("secret")
    if _titled(text):
        kinds.add("person")
    return kinds


def script_of(word: str) -> str:
    c = word[0]
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "han" if "一" <= c <= "鿿" else "latin"


def _iban_check(country: str, body: str) -> int:
    """The check digits, from 2 to 98, that make an account number's remainder by 97 one."""
    return 98 - int("".join(str(int(c, 36)) for c in f"{body}{country}00")) % 97


def _luhn(digits: str) -> int:
    """Check sum of a card number: every second digit from the right counts double, less 9 over 9."""
    return sum(2 * d - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, reversed(digits))))


_ACCENTED = "".join(chr(c) for c in range(0xE0, 0x100) if chr(c) not in "÷ß")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-ß" + _ACCENTED + "".join(chr(c) for c in range(0xC0, 0xDF) if chr(c) != "×"))
_LOCAL_ENDS = _LOCAL - set(".")
_STARTS = _LOCAL - set("._%+-")


def _addresses(pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """The pattern's matches, each tried once at the first letter or digit of the whole local part before an @."""
    at, end = -1, 0
    while (at := text.find("@", at + 1)) >= 0:
        if at <= end or text[at - 1] not in _LOCAL_ENDS:
            continue
        start = i = at
        while i > end and text[i - 1] in _LOCAL:
            i -= 1
            if text[i] in _STARTS:
                start = i
        if start < at and (m := pattern.match(text, start)):
            end = m.end()
            yield m


class _Spans:
    """Taken spans, none overlapping, in order."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def take(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, a)
        if i and self.ends[i - 1] > a or i < len(self.starts) and self.starts[i] < b:
            return False
        self.starts.insert(i, a)
        self.ends.insert(i, b)
        return True


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, type, value)`` in order, none overlapping; the earlier type of PATTERNS wins.

    A value is what co-refers: lower-case addresses, digits without separators, a part of a name with its role, script and
    gender (parts of a name found once are found again in the rest of the text). A given name's gender is its
    title's, else that of the first title that the text gives to it, else the listed one, else one by a hash: a text
    without conflicting titles has one gender and so one surrogate a name.
    """
    found: list[tuple[int, int, str, str]] = []
    spans = _Spans()
    names: list[tuple[int, int, str, str, str]] = []  # start, end, role, word, the title's gender
    worth = _worth(text)
    for kind, pattern in PATTERNS.items():
        if kind not in worth:
            continue
        for m in _addresses(pattern, text) if kind == "email" else pattern.finditer(text):
            if kind in ("person", "named"):
                names += [x for x in _name_parts(m, kind) if spans.take(*x[:2])]
                continue
            g = next((i for i in range(1, (m.re.groups or 0) + 1) if m.group(i)), 0) if kind == "secret" else 0
            a, b = m.span(g)
            value = text[a:b]
            if kind == "email":
                value = value.lower()
            elif kind in ("card", "phone", "ssn"):
                value = re.sub(r"\D", "", value)
                if kind == "card" and not 13 <= len(value) <= 19 or kind == "phone" and not 7 <= len(value) <= 15:
                    continue
            elif kind == "iban":
                value = value.replace(" ", "")
            if spans.take(a, b):
                found.append((a, b, kind, value))
    if not names:
        return sorted(found)
    titled: dict[str, str] = {}
    for _, _, role, word, gender in names:
        if role == "given" and gender:
            titled.setdefault(word.lower(), gender)
    parts: dict[str, str] = {}
    whole: dict[str, list[tuple[int, int, str]]] = {}  # Chinese names, which stand in no spaces
    for k, (a, b, role, word, gender) in enumerate(names):
        value = _name_value(role, word, gender or titled.get(word.lower(), ""))
        for form in _forms(role, word):
            parts.setdefault(form, value)
        found.append((a, b, "person", value))
        if role == "given" and script_of(word) == "han" and k and names[k - 1][1] == a:
            whole.setdefault(text[names[k - 1][0] : b], [(0, 1, found[-2][3]), (1, b - a + 1, value)])
    for m in re.finditer(r"\w+", text):
        if m[0] in parts and spans.take(*m.span()):
            found.append((*m.span(), "person", parts[m[0]]))
    for name, each in whole.items():
        at = text.find(name)
        while at >= 0:
            if spans.take(at, at + len(name)):
                found += [(at + a, at + b, "person", value) for a, b, value in each]
            at = text.find(name, at + 1)
    return sorted(found)


def _name_parts(m: re.Match, kind: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, role, word, the title's gender) of the words of a name; both sides of a hyphen are words, an initial is one, particles and
    what stands before an apostrophe are none."""
    if kind == "person" and m[3]:  # a Chinese name with its title behind
        return [(*m.span(3), "family", m[3], ""), (*m.span(4), "given", m[4], "m" if m[5] == "先生" else "f")]
    start, text = (m.start(2), m[2]) if kind == "person" else (m.start(), m[0])
    gender = next((g for g, titles in TITLES.items() if m[1] in titles), "") if kind == "person" else ""
    last = max(text.rfind(c) for c in " \u00a0\t\n\r") + 1
    out = []
    for x in re.finditer(r"[^\W\d_]+", text):
        after = text[x.end() : x.end() + 1]
        if x[0] in _PARTICLES or len(x[0]) == 1 and after in ("'", "’"):
            continue
        role = "initial" if len(x[0]) == 1 and after == "." else "family" if x.start() >= last else "given"
        out.append((start + x.start(), start + x.end(), role, x[0], gender))
    return out


def _forms(role: str, word: str) -> list[str]:
    """A word and, of a Russian family name, the form of the other gender; an initial is found only where it stands."""
    if role == "initial":
        return []
    if role == "given" or script_of(word) != "cyrillic":
        return [word]
    other = next((word[: -len(a)] + b for a, b in FEMININE if word.endswith(a)), None)
    return [word, other or word + "а"]


def _name_value(role: str, word: str, gender: str) -> str:
    low, script = word.lower(), script_of(word)
    if role == "initial":
        letters, plain = ALPHABETS[script], unicodedata.normalize("NFD", low)[0]
        return f"initial:{script}::{plain if plain in letters else letters[ord(plain) % len(letters)]}"
    if role == "given":
        gender = gender or _GENDER.get(low) or "mf"[hashlib.sha256(low.encode()).digest()[0] & 1]
        return f"given:{script}:{gender}:{low}"
    if script == "cyrillic":  # a woman's family name is her husband's or father's with another end
        low = next((low[: -len(a)] + b for a, b in FEMININE if low.endswith(a)), low)
    return f"family:{script}::{low}"


# ---------------------------------------------------------------- keyed permutations


def _prf(key: bytes, tweak: str, data: str) -> int:
    return int.from_bytes(hmac.new(key, f"{tweak}\0{data}".encode(), hashlib.sha256).digest()[:24], "big")


def permute(key: bytes, tweak: str, x: int, size: int, rounds: int = 8) -> int:
    """A keyed permutation of [0, size)."""
    if size < 2:
        return x
    half = (max(2, (size - 1).bit_length()) + 1) // 2
    mask = (1 << half) - 1
    while True:
        a, b = x >> half, x & mask
        for r in range(rounds):
            a, b = b, a ^ (_prf(key, tweak, f"{r}:{half}:{b}") & mask)
        x = a << half | b
        if x < size:  # walk the cycle until back inside: still a permutation
            return x


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def reshape(key: bytes, tweak: str, value: str, classes=_CLASSES) -> str:
    """Another value of the same format: characters of each class stay in it, others stay themselves."""
    of = [next((c for c in classes if ch in c), None) for ch in value]
    form = "".join(ch if c is None else c[0] for ch, c in zip(value, of))
    x, size = 0, 1
    for ch, c in zip(value, of):
        if c:
            x, size = x * len(c) + c.index(ch), size * len(c)
    x = permute(key, f"{tweak}:{form}", x, size)
    out = []
    for ch, c in zip(reversed(value), reversed(of)):
        if c:
            x, d = divmod(x, len(c))
            ch = c[d]
        out.append(ch)
    return "".join(reversed(out))


_HEX = ("0123456789abcdef",), ("0123456789ABCDEF",)


def _name(key: bytes, value: str, attempt: int) -> str:
    """A composed name of four syllables, one more with each attempt; another letter for an initial; a Chinese one has two characters and more."""
    role, script, gender, low = value.split(":", 3)
    if role == "initial":
        letters = ALPHABETS[script]
        return letters[(letters.index(low) + 1 + _prf(key, "initial", script) % (len(letters) - 1)) % len(letters)].upper()
    n = _prf(key, f"person:{attempt}", value)
    if script == "han":
        if role == "family":
            at = HAN_FAMILY.index(low)
            return HAN_FAMILY[permute(key, "han", at, len(HAN_FAMILY))]
        out = ""
        for _ in range(attempt + 1):
            n, c = divmod(n, HAN[1])
            out += chr(HAN[0] + c)
        ends = GIVEN["han", gender]
        return out + ends[n % len(ends)]
    out = ""
    for _ in range(attempt + 4):
        for letters in SYLLABLES[script]:
            n, c = divmod(n, len(letters))
            out += letters[c]
    ends = ENDS[script, gender or role]
    return (out + ends[n % len(ends)]).capitalize()


@lru_cache(100_000)
def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of a canonical value; ``attempt`` draws another one after a collision."""
    tweak = f"{kind}:{attempt}"
    if kind == "person":
        return _name(key, value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        labels, _, top = domain.rpartition(".")
        return f"{reshape(key, tweak + ':local@' + domain, local, (*_CLASSES, _ACCENTED))}@{reshape(key, tweak + ':domain', labels)}.{top}"
    if kind == "card":
        body = value[0] + reshape(key, f"{tweak}:{value[0]}", value[1:-1])
        off = (_luhn(value[:-1] + "0") + int(value[-1])) % 10  # 0 if the check digit holds
        return body + str((off - _luhn(body + "0")) % 10)
    if kind == "ipv4":
        n = 0
        for octet in value.split("."):
            n = n << 8 | int(octet)
        public = n < 224 << 24  # multicast and reserved addresses stay in their range
        low, size = (0, 224 << 24) if public else (224 << 24, 32 << 24)
        n = low + permute(key, f"{tweak}:{public}", n - low, size)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "phone":  # the last ten digits alike with and without a country's code
        return value[:-10] + reshape(key, tweak, value[-10:])
    if kind == "iban":
        country, digits, body = value[:2], value[2:4], value[4:]
        if not digits.isdecimal() or not 2 <= int(digits) <= 98:  # no check digits: they stay as they are
            return country + digits + reshape(key, f"{tweak}{country}:{digits}", body)
        off = (int(digits) - _iban_check(country, body)) % 97  # 0 if they hold; what does not hold is as far off afterwards
        body = reshape(key, tweak + country, body)
        return f"{country}{(_iban_check(country, body) - 2 + off) % 97 + 2:02}{body}"
    if kind == "secret":
        for prefix in ("AKIA", "ghp_", "sk-", "xoxa-", "xoxb-", "xoxp-"):
            if value.startswith(prefix):
                return prefix + reshape(key, tweak + prefix, value[len(prefix) :])
        for classes in _HEX:
            if all(c in classes[0] for c in value):
                return reshape(key, tweak, value, classes)
    return reshape(key, tweak, value)


def dress(kind: str, original: str, new: str) -> str:
    """A surrogate in the spelling of the mention: separators and letter case."""
    if kind in ("card", "phone", "ssn", "iban") and len(new) != len(original):
        it = iter(new)
        return "".join(next(it) if c.isalnum() else c for c in original)
    if kind == "email":
        return "".join(b.upper() if a.isupper() else b for a, b in zip(original, new))
    if kind == "person":
        low = original.lower()
        if script_of(low) == "cyrillic" and new.endswith(tuple(ENDS["cyrillic", "family"])) and low.endswith(tuple(a for a, _ in FEMININE)):
            new += "а"
        return new.upper() if original.isupper() and len(original) > 1 else new
    return new


def entity_hash(key: bytes, kind: str, value: str) -> bytes:
    """What stands for an entity outside its row: nothing can be read from it without the key."""
    return hmac.new(key, f"entity\0{kind}\0{value}".encode(), hashlib.sha256).digest()[:16]


#: Types whose surrogates can collide; the others are permutations.
DRAWN = ("person", "secret")
#: Stands, in place of an entity's hash, for the attempt that all drawn entities begin with.
ALL = b""


def _attempt(again: dict[bytes, int], entity: bytes) -> int:
    return again.get(entity, again.get(ALL, 0))


def replace(text: str, key: bytes, again: dict[bytes, int] | None = None) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with surrogates and the new spans ``(start, end, type)``; ``again`` has the attempts of entities that collided,
    as ``collisions`` gives them."""
    out, spans, at, size = [], [], 0, 0
    for a, b, kind, value in detect(text):
        attempt = _attempt(again, entity_hash(key, kind, value)) if again and kind in DRAWN else 0
        new = dress(kind, text[a:b], surrogate(key, kind, value, attempt))
        out += [text[at:a], new]
        size += a - at
        spans.append((size, size + len(new), kind))
        size += len(new)
        at = b
    if not spans:
        return text, spans
    return "".join([*out, text[at:]]), spans


# ---------------------------------------------------------------- over tables

#: Entities that may be drawn again one by one; they are kept in the driver and sent to every task (some 100 bytes each).
MOST_AGAIN = 200_000


def _scope(kind: str, value: str) -> str:
    """Where surrogates must differ: a type, of names also their role."""
    return f"person:{value.split(':', 1)[0]}" if kind == "person" else kind


def _met(docs: DataFrame, key: bytes, text: str, again: dict[bytes, int]) -> DataFrame:
    """``(entity, attempt)`` of all but the first of the distinct entities that share a surrogate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = set()
            for t in b.column(0):
                if t.is_valid:
                    seen |= {x[2:] for x in detect(t.as_py()) if x[2] in DRAWN}
            rows = []
            for kind, value in seen:
                e = entity_hash(key, kind, value)
                attempt = _attempt(again, e)
                new = f"{_scope(kind, value)}\0{surrogate(key, kind, value, attempt)}"
                rows.append((hashlib.sha256(new.encode()).digest()[:16], attempt, e))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.binary(), pa.int32(), pa.binary()))], ["s", "attempt", "e"])

    drawn = docs.select(F.col(text).alias("t")).mapInArrow(run, "s binary, attempt int, e binary").distinct()
    met = drawn.groupBy("s").agg(F.array_sort(F.collect_list(F.struct("attempt", "e"))).alias("es")).where(F.size("es") > 1)
    return met.select(F.explode(F.slice("es", 2, F.size("es"))).alias("x")).select("x.e", "x.attempt")


def collisions(docs: DataFrame, key: bytes, text: str = "text", most: int = MOST_AGAIN, most_rounds: int = 20) -> dict[bytes, int]:
    """Attempts, by ``entity_hash``, of the entities that must be drawn again, so that no two distinct entities of a
    type (names: of a role) share a surrogate. Of those that met the one with the fewest attempts, then the smallest
    hash, keeps its surrogate. A round more is read only if some met. If that takes over ``most`` exceptions, all entities
    begin one attempt later, in a larger space, and the exceptions are found anew."""
    again: dict[bytes, int] = {}
    for _ in range(most_rounds):
        met = _met(docs, key, text, again).limit(most + 1).toArrow()
        if not met.num_rows:
            return again
        more = again | {e: a + 1 for e, a in zip(met["e"].to_pylist(), met["attempt"].to_pylist())}
        again = more if len(more) - (ALL in more) <= most else {ALL: again.get(ALL, 0) + 1}
    raise RuntimeError("surrogates still collide")


def anonymise(docs: DataFrame, key: bytes, text: str = "text", check: bool = True, most: int = MOST_AGAIN) -> DataFrame:
    """``docs`` with its texts' entities replaced (``n_chars``, if there, follows), plus
    ``pii_spans array<struct<start,end,type>>``: where surrogates lie, in code points of the new text.

    Defined cases: a null text stays null with no spans; an empty text stays empty; equal entities get
    equal surrogates in all rows, whatever their ids, null and repeated ones included; an empty table gives no rows; a
    column of the input named pii_spans is replaced, all others are kept. A text is worked on whole, in time in
    proportion to its length and the logarithm of its entities.
    """
    if not key:
        raise ValueError("a key is needed")
    cols = [c for c in docs.columns if c != "pii_spans"]
    return _apply(docs.select(*[F.col(f"`{c}`") for c in cols]), cols, key, text, collisions(docs, key, text, most) if check else {})


def _apply(rows: DataFrame, cols: list[str], key: bytes, text: str, again: dict[bytes, int]) -> DataFrame:
    at, n_chars = cols.index(text), cols.index("n_chars") if "n_chars" in cols else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("type", pa.string())]))
        for b in batches:
            out, spans, sizes = [], [], []
            for t in b.column(at).to_pylist():
                new, where = (t, []) if t is None else replace(t, key, again)
                out.append(new)
                spans.append([{"start": s, "end": e, "type": k} for s, e, k in where])
                sizes.append(None if new is None else len(new))
            arrays = list(b.columns)
            arrays[at] = pa.array(out, b.schema.field(at).type)
            if n_chars is not None:
                arrays[n_chars] = pa.array(sizes, pa.int64()).cast(b.schema.field(n_chars).type)
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(spans, spans_type)], [*cols, "pii_spans"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in cols)
    return rows.mapInArrow(run, f"{schema}, pii_spans array<struct<start:int,end:int,type:string>>")
