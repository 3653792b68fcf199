"""Made-up secrets and look-alikes set into texts, as labelled examples for the field of ``secret_scan``.

Every kind is a small function of a random generator that returns
(before, value, after); only the value counts as secret.  A look-alike has the
outer form of a secret (digits, mixed case, a name with a sign) and is none.
All randomness comes from the seed given, so the same texts give the same
examples.

Defined results: texts without a word give no example, and so do no texts.
Repeated texts give an example each.  Texts are never changed; the examples
are stretches of them, around the inserted value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALNUM = LOWER + UPPER + DIGITS
#: Names that secrets are assigned to and that the fixed patterns don't know.
NAMES = ("pwd", "passphrase", "pass", "passcode", "auth_key", "access_key", "private_key", "client_key", "credential",
         "credentials", "signing_key", "encryption_key", "session_key", "secret_access_key", "login_pass", "pin")
#: Names of ordinary settings and numbers.
ORDINARY = ("page", "count", "id", "version", "width", "height", "color", "session", "season", "order", "room", "model", "size",
            "item", "date", "code", "name", "title", "chapter", "batch", "level", "port", "timeout", "volume", "issue", "part")
Random = np.random.Generator
Snippet = tuple[str, str, str]


def chars(random: Random, alphabet: str, low: int, high: int) -> str:
    return "".join(random.choice(list(alphabet), int(random.integers(low, high + 1))))


def one(random: Random, options: Sequence[str]) -> str:
    return options[int(random.integers(len(options)))]


def _digits(random: Random, *sizes: int, sign: str = "-") -> str:
    return sign.join(chars(random, DIGITS, n, n) for n in sizes)


def _memorable(random: Random) -> str:
    """A password of word-like runs with digits and now and then a capital."""
    runs = [chars(random, LOWER, 3, 7) + chars(random, DIGITS, 1, 3) for _ in range(int(random.integers(1, 3)))]
    if random.random() < 0.4:
        runs.append(chars(random, LOWER, 3, 6))
    word = "".join(runs)
    return word.capitalize() if random.random() < 0.3 else word


def _assigned(random: Random) -> Snippet:
    value = _memorable(random) if random.random() < 0.4 else chars(random, one(random, (LOWER + DIGITS, ALNUM)), 10, 32)
    quote = one(random, ("", "", '"', "'"))
    return one(random, NAMES) + one(random, ("=", ": ", " = ", ":")) + quote, value, quote


def _prefixed(random: Random) -> Snippet:
    prefix = one(random, ("ghp", "gho", "glpat", "npm", "pypi", "shpat", "dop", chars(random, LOWER, 2, 5)))
    return "", prefix + one(random, "_-") + chars(random, ALNUM, 20, 44), ""


def _sectioned(random: Random) -> Snippet:
    parts = [one(random, ("sk", "pk", "rk", "xoxb", "xoxp")), *([one(random, ("live", "test", "proj"))] if random.random() < 0.5 else []),
             *([_digits(random, 11)] if random.random() < 0.4 else []), chars(random, ALNUM, 24, 40)]
    return "", one(random, "-_").join(parts), ""


def _base64(random: Random) -> Snippet:
    before = one(random, ("", "", "key ", "cloud key: ", "aws_secret_access_key = ", "secret key "))
    return before, chars(random, ALNUM + "+/", 36, 64) + one(random, ("", "=", "==")), ""


def _bearer(random: Random) -> Snippet:
    value = chars(random, one(random, (ALNUM, LOWER[:6] + DIGITS, ALNUM + "-_")), 20, 48)
    return one(random, ("Authorization: Bearer ", "Bearer ", "authorization: bearer ")), value, ""


def _web_token(random: Random) -> Snippet:
    return "", "eyJ" + ".".join(chars(random, ALNUM + "-_", n, n + 20) for n in (16, 30, 24)), ""


def _connection(random: Random) -> Snippet:
    value = _memorable(random) if random.random() < 0.5 else chars(random, ALNUM, 8, 20)
    scheme = one(random, ("postgres", "mysql", "mongodb", "redis", "amqp", "ftp", "https"))
    host = f"{chars(random, LOWER, 3, 8)}.{one(random, ('example', 'internal', 'local'))}"
    return f"{scheme}://{chars(random, LOWER, 3, 8)}:", value, f"@{host}/{chars(random, LOWER, 2, 6)}"


def _pem(random: Random) -> Snippet:
    owner = one(random, ("RSA ", "EC ", "", "OPENSSH "))
    body = "\n".join(chars(random, ALNUM + "+/", 64, 64) for _ in range(int(random.integers(1, 4))))
    return f"-----BEGIN {owner}PRIVATE KEY-----\n", "MII" + body + "==", f"\n-----END {owner}PRIVATE KEY-----"


SECRETS: dict[str, Callable[[Random], Snippet]] = {
    "assigned": _assigned, "prefixed": _prefixed, "sectioned": _sectioned, "base64": _base64, "bearer": _bearer,
    "web_token": _web_token, "connection": _connection, "pem": _pem,
}


def _uuid(random: Random) -> str:
    text = "-".join(chars(random, LOWER[:6] + DIGITS, n, n) for n in (8, 4, 4, 4, 12))
    return text.upper() if random.random() < 0.2 else text


def _setting(random: Random) -> str:
    value = one(random, (chars(random, DIGITS, 1, 6), chars(random, LOWER, 3, 9), chars(random, LOWER, 4, 8) + _digits(random, 4),
                         _digits(random, 1, 2, 1, sign="."), "#" + chars(random, LOWER[:6] + DIGITS, 6, 6)))
    return one(random, ORDINARY) + one(random, ("=", ": ", " = ", ":")) + value


LOOKALIKES: dict[str, Callable[[Random], str]] = {
    "uuid": _uuid,
    "order": lambda r: one(r, ("order ", "order no. ", "invoice ", "#", "ticket ")) + one(r, (
        chars(r, UPPER, 1, 3) + "-" + _digits(r, 4, 6), _digits(r, 9), _digits(r, 3, 7, 7), chars(r, UPPER, 1, 2) + _digits(r, 8))),
    "telephone": lambda r: one(r, (f"+{_digits(r, 2, 3, 7, sign=' ')}", f"({_digits(r, 3)}) {_digits(r, 3, 4)}", _digits(r, 3, 3, 4))),
    "link": lambda r: f"https://{chars(r, LOWER, 4, 9)}.{one(r, ('org', 'com', 'net'))}/{chars(r, LOWER, 1, 7)}/" + one(r, (
        chars(r, LOWER[:6] + DIGITS, 7, 40), chars(r, DIGITS, 4, 12), chars(r, LOWER, 5, 9) + "-" + chars(r, LOWER, 4, 9),
        chars(r, ALNUM, 8, 11))),
    "hash": lambda r: one(r, ("commit ", "sha256 ", "revision ", "checksum ")) + chars(r, LOWER[:6] + DIGITS, 7, 23),
    "setting": _setting,
    "version": lambda r: one(r, ("v", "version ", "")) + _digits(r, 1, 2, 2, sign="."),
    "moment": lambda r: f"{_digits(r, 4, 2, 2)}{one(r, ('T', ' '))}{_digits(r, 2, 2, 2, sign=':')}",
    "product": lambda r: chars(r, UPPER, 2, 4) + one(r, ("-", "")) + chars(r, DIGITS, 3, 5) + chars(r, UPPER, 0, 2),
    "file": lambda r: f"{one(r, ('IMG', 'scan', 'report', 'DSC'))}_{_digits(r, 8, 4, sign='_')}.{one(r, ('jpg', 'pdf', 'csv'))}",
    "address": lambda r: one(r, (_digits(r, 3, 2, 1, 3, sign="."), ":".join(chars(r, LOWER[:6] + DIGITS, 2, 2) for _ in range(6)))),
    "parcel": lambda r: one(r, ("1Z" + chars(r, UPPER + DIGITS, 6, 6) + _digits(r, 10), "ISBN " + _digits(r, 3, 1, 4, 4, 1))),
    "identifier": lambda r: one(r, (
        "_".join(chars(r, LOWER, 2, 7) for _ in range(3)), "".join(chars(r, LOWER, 3, 7).capitalize() for _ in range(4)),
        chars(r, LOWER, 4, 9) + str(int(r.integers(1, 2100))), chars(r, LOWER, 16, 28))),
    "name only": lambda r: one(r, NAMES) + one(r, (": ", "=", " ")) + one(r, ("unknown", "none", "required", "********", "<value>", "changed")),
}


def example(random: Random, text: str, value: str, before: str = "", after: str = "", words: int = 40) -> tuple[str, int, int] | None:
    """(stretch of the text with the value set in, start, end); None where the text has no word."""
    found = text.split()
    if not found:
        return None
    at = int(random.integers(len(found) + 1))
    left, right = found[max(0, at - words):at], found[at:at + words]
    gap = "\n" if random.random() < 0.3 else " "
    opening = (" ".join(left) + gap if left else "") + before
    closing = after + (one(random, (gap, ". ", ", ")) + " ".join(right) if right else "")
    return opening + value + closing, len(opening), len(opening) + len(value)


def examples(texts: Sequence[str], each: int, seed: int, kinds: Sequence[str] = tuple(SECRETS)) -> list[tuple[str, int, int, bool]]:
    """For every text ``each`` secrets of the kinds and twice as many look-alikes: (text, start, end, is secret)."""
    random = np.random.default_rng(seed)
    others = tuple(LOOKALIKES)
    found: list[tuple[str, int, int, bool]] = []
    for text in texts:
        for turn in range(3 * each):
            if turn < each:
                before, value, after = SECRETS[one(random, kinds)](random)
            else:
                before, value, after = "", LOOKALIKES[one(random, others)](random), ""
            made = example(random, text, value, before, after)
            if made:
                found.append((*made, turn < each))
    return found
