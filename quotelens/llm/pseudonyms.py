"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

Values are found by their form and validated: card numbers by the Luhn sum, IBANs by their
remainder mod 97, social security numbers and North American phone numbers by their ranges, dates
by the calendar, addresses by their octets. A value is numbered within all valid values of its
format and that number is permuted under a key, so the pseudonym is valid in the same format,
equal values get equal pseudonyms in every document and task, and who has the key can undo it.
Names in e-mail addresses and access keys are permuted within their letter and digit pattern.

A pseudonym depends on its value and the key alone. Where pseudonyms stand is listed with the text,
and who has the key takes them back there; so it does not matter what the text around looks like then.

Card numbers, IBANs and dates may stand beside other numbers, capitals and each other: at each start
the possible lengths are tried from long to short until one is valid. IBANs have the length of their
country. Card numbers that begin and are as long as those of the large issuers come first, in the
usual groups, in one piece and in any grouping, so that a number before or after them is not taken for a
part; then others in the same order, where a row of numbers passes the Luhn sum by chance in one of ten
tries. Of two valid readings that are equal in all this the first counts. A phone number with a foreign country code has no check and takes all groups of
digits that follow it.

No table of pseudonyms is kept and nothing is shuffled.

Edge cases: null texts stay null, with no values. Texts are read whole at any length. Repeated rows
give equal results. Time is linear in the text and its values. An empty table gives an empty result.
Columns of the input that bear a result's name are replaced.
"""

import datetime
import hashlib
import re
import string
from bisect import bisect_left

import pandas as pd
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Permutation:
    """A keyed permutation of 0 .. size - 1 for any size; ``tweak`` keeps formats apart."""

    def __init__(self, key):
        self.key = key

    def _share(self, tweak, turn, half, size):
        message = f"{tweak}|{turn}|{half}".encode()
        wide = hashlib.blake2b(message, key=self.key, digest_size=16 + size.bit_length() // 8)
        return int.from_bytes(wide.digest(), "big") % size

    def _once(self, value, a, b, tweak, back):
        left, right = divmod(value, b)
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if turn % 2 == 0:
                left = (left + sign * self._share(tweak, turn, right, a)) % a
            else:
                right = (right + sign * self._share(tweak, turn, left, b)) % b
        return left * b + right

    def __call__(self, value, size, tweak, valid=None, back=False):
        """Walks on until the value is in range and ``valid``, as it was before."""
        a = max(1, int(size**0.5)) if size < 1 << 50 else 1 << (size.bit_length() // 2)
        b = -(-size // a)
        tweak = f"{tweak}|{size}"
        while True:
            value = self._once(value, a, b, tweak, back)
            if value < size and (valid is None or valid(value)):
                return value


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10


def _refill(form, digits):
    """``form`` with its digits replaced in order."""
    following = iter(digits)
    return "".join(next(following) if c in string.digits else c for c in form)


def _digits(text):
    return "".join(c for c in text if c in string.digits)


def _card(text, permute, back):
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or _luhn(digits):
        return None
    n = len(digits) - 2
    middle = permute(int(digits[1:-1]), 10**n, "card", back=back)
    payload = f"{digits[0]}{middle:0{n}d}"
    return _refill(text, payload + str(-_luhn(payload + "0") % 10))


def _iban(text, permute, back):
    plain = text.replace(" ", "")
    if len(plain) != _IBAN_LENGTHS.get(plain[:2], len(plain)) or not 15 <= len(plain) <= 34:
        return None
    if _iban_remainder(plain) != 1:
        return None
    body = _by_class(plain[4:], permute, "iban", back)
    check = 98 - _iban_remainder(plain[:2] + "00" + body)
    following = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(following) for c in text)


def _iban_remainder(plain):
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _ssn(text, permute, back):
    area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    number = (place * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(permute(number, 898 * 99 * 9999, "ssn", back=back), 9999)
    area, group = divmod(number, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(text, permute, back):
    digits = _digits(text)
    rest, lead = digits[-10:], digits[:-10]
    if len(rest) < 10 or rest[0] in "01" or rest[3] in "01" or lead not in ("", "1"):
        return None
    number = (int(rest[0]) - 2) * 8 + int(rest[3]) - 2
    number = number * 10**8 + int(rest[1:3] + rest[4:])
    first, others = divmod(permute(number, 64 * 10**8, "phone", back=back), 10**8)
    others = f"{others:08d}"
    a, b = divmod(first, 8)
    return _refill(text, f"{lead}{a + 2}{others[:2]}{b + 2}{others[2:]}")


def _foreign_phone(text, permute, back):
    digits = _digits(text)
    if not 9 <= len(digits) <= 15:
        return None
    n = len(digits) - 3
    return _refill(text, digits[:3] + f"{permute(int(digits[3:]), 10**n, 'dial', back=back):0{n}d}")


def _address(text, permute, back):
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255 or any(x != str(int(x)) for x in text.split(".")):
        return None
    number = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, "ip", back=back)
    return ".".join(map(str, number.to_bytes(4, "big")))


def _date(text, permute, back):
    """Year first, or day first with dots; with slashes month first unless that is no date."""
    mark = text[4] if text[4] in "-/" and text[:4].isdigit() else next(c for c in text if c in "./")
    parts = text.split(mark)

    def day(order):
        try:
            return datetime.date(*(int(parts[i]) for i in order)).toordinal()
        except ValueError:
            return 0

    order, least_day = ((0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0)), 1
    if mark == "/" and len(parts[0]) < 4:
        if day((2, 0, 1)):
            order = 2, 0, 1
        else:
            least_day = 13  # day first, which only days after the 12th show
    most_month, most_day = (9 if len(parts[i]) == 1 else 31 for i in order[1:])

    def valid(n):
        d = datetime.date.fromordinal(FIRST_DAY + n)
        return d.month <= most_month and least_day <= d.day <= most_day

    here = day(order)
    if not FIRST_DAY <= here <= LAST_DAY:
        return None
    size = LAST_DAY - FIRST_DAY + 1
    moved = datetime.date.fromordinal(
        FIRST_DAY + permute(here - FIRST_DAY, size, "date", valid, back)
    )
    new = [""] * 3
    for place, value in zip(order, (moved.year, moved.month, moved.day)):
        new[place] = f"{value:0{len(parts[place])}d}"
    return mark.join(new)


_ALPHABETS = (string.digits, string.ascii_lowercase, string.ascii_uppercase)


def _by_class(text, permute, tweak, back, alphabets=_ALPHABETS):
    """Digits to digits and letters to letters; other characters stay."""
    kinds = [next((i for i, a in enumerate(alphabets) if c in a), None) for c in text]
    number, size = 0, 1
    for c, kind in zip(text, kinds):
        if kind is not None:
            number = number * len(alphabets[kind]) + alphabets[kind].index(c)
            size *= len(alphabets[kind])
    form = "".join(c if k is None else "dlu"[k] for c, k in zip(text, kinds))
    number, made = permute(number, size, f"{tweak}|{form}", back=back), []
    for c, kind in zip(reversed(text), reversed(kinds)):
        if kind is not None:
            number, at = divmod(number, len(alphabets[kind]))
            c = alphabets[kind][at]
        made.append(c)
    return "".join(reversed(made))


def _email(text, permute, back):
    name, at, domain = text.rpartition("@")
    return _by_class(name, permute, "email", back) + at + domain


def _secret(text, permute, back):
    lead = re.match(r"AKIA|(?:token|password|secret|api_?key)\s*[=:]\s*\"?", text, re.I).group()
    body = text[len(lead) :]
    if lead != "AKIA" and re.fullmatch(r"[0-9a-f]+", body):
        return lead + _by_class(body, permute, "hex", back, (string.digits, "abcdef", ""))
    return lead + _by_class(body, permute, "secret", back)


#: Lengths of IBANs by country.
_IBAN_LENGTHS = {k: int(n) for k, n in (x.split(":") for x in (
    "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 "
    "DO:28 EE:20 EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 "
    "IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 "
    "MR:27 MT:31 MU:30 NL:18 NO:15 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:24 SC:31 SD:18 SE:24 SI:19 "
    "SK:24 SM:27 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20"
).split())}

#: Beginnings and lengths of card numbers of the large issuers.
_ISSUED = re.compile(
    r"4\d{15}|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}|3[47]\d{13}"
    r"|6(?:011|5\d\d)\d{12}|35(?:2[89]|[3-8]\d)\d{12}|3(?:0[0-5]|[68]\d)\d{11}"
)


def _issued(text):
    return _ISSUED.fullmatch(_digits(text)) is not None


#: Forms of each kind, the first that fits and is valid counts. Lists are tried in turn,
#: each at all lengths.
_FORMS = {
    "iban": ([r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"], _iban),
    "date": ([r"(?<!\d)(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})"], _date),
    "address": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", _address),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "card": ([(r"(?<!\d)(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{4,5})", _issued),
              (r"(?<!\d)\d{13,19}", _issued), (r"(?<!\d)\d(?:[ -]?\d){12,18}", _issued), r"(?<!\d)\d{13,19}",
              r"(?<!\d)(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5})",
              r"(?<!\d)\d(?:[ -]?\d){12,18}"], _card),
    "phone": (r"(?<![\d+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)", _phone),
    "dial": (r"(?<![\d+])\+[1-9]\d{0,2}(?:[ .-]?\(?\d{2,5}\)?){2,5}(?!\d)", _foreign_phone),
    "secret": (r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}(?![A-Za-z0-9])|(?i:token|password|secret|api_?key)\s*[=:]\s*\"?[A-Za-z0-9+/_-]{8,})", _secret),
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", _email),
}


def _is_valid(kind, text):
    return _FORMS[kind][1](text, lambda value, *_, **__: value, False) is not None


def _blank(text, spans):
    """``text`` with what is in ``spans`` replaced by as many zero characters."""
    parts, at = [], 0
    for start, end, *_ in sorted(spans):
        parts += [text[at:start], "\0" * (end - start)]
        at = end
    return "".join(parts) + text[at:]


def _at_all_lengths(kind, forms, text):
    """Valid values, as (start, end, kind)."""
    spans = []
    for form in forms:
        form, fits = form if isinstance(form, tuple) else (form, None)
        form, at, here = re.compile(form), 0, []
        while m := form.search(text, at):
            start, longest = m.span()
            at = start + 1
            for end in range(longest, start, -1):
                cut = text[end : end + 1]
                if (cut.isdigit() or kind == "iban" and cut.isalpha()) and cut.isascii():
                    continue
                if end < longest and not form.fullmatch(text, start, end):
                    continue
                if (fits is None or fits(text[start:end])) and _is_valid(kind, text[start:end]):
                    here.append((start, end, kind))
                    at = end
                    break
        text = _blank(text, here)
        spans += here
    return spans


def _find(text, kinds):
    """Valid values, as (start, end, kind) in order.

    Kinds are tried in turn; what one has taken no later kind touches.
    """
    has_digit, has_at, done = re.search(r"\d", text) is not None, "@" in text, []
    for kind in kinds:
        form = _FORMS[kind][0]
        if not (has_at if kind == "email" else has_digit or kind == "secret"):
            continue
        if isinstance(form, list):
            done = sorted(done + _at_all_lengths(kind, form, _blank(text, done) if done else text))
            continue
        starts, more = [s[0] for s in done], []
        for m in re.finditer(form, text):
            before = bisect_left(starts, m.end()) - 1  # spans do not overlap: the last that begins earlier
            if (before < 0 or done[before][1] <= m.start()) and _is_valid(kind, m.group()):
                more.append((*m.span(), kind))
        done = sorted(done + more)
    return done


def replace(text, permute, kinds=tuple(_FORMS), back=False, spans=None):
    """The text with pseudonyms, and (kind, start, end) of each in the new text.

    With ``back`` the pseudonyms at ``spans`` become values again. Without spans they are looked for,
    which is right only where no pseudonym stands beside a number, capitals or another one.
    """
    found = _find(text, kinds) if spans is None else sorted((a, b, k) for k, a, b in spans)
    parts, made, at, length = [], [], 0, 0
    for start, end, kind in found:
        new = _FORMS[kind][1](text[start:end], permute, back)
        parts += [text[at:start], new]
        length += start - at
        made.append((kind, length, length + len(new)))
        length += len(new)
        at = end
    parts.append(text[at:])
    return "".join(parts), made


def pseudonymise(df, key, text="text", name="found", kinds=tuple(_FORMS), back=False):
    """``df`` with pseudonyms in ``text``; ``found`` lists kind, start and end of each.

    ``key`` is bytes, at most 64 of them. With ``back`` true the pseudonyms that ``found`` lists become
    values again, and ``found`` says where those stand.
    """
    spans = F.col(name) if back else F.lit(None).cast("array<struct<kind:string,start:int,end:int>>")

    @F.pandas_udf("text string, found array<struct<kind:string,start:int,end:int>>")
    def run(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        permute = Permutation(key)
        rows = []
        for t, known in zip(texts, places):
            known = None if known is None else [(k["kind"], k["start"], k["end"]) for k in known]
            rows.append((t, []) if t is None else replace(t, permute, kinds, back, known if back else None))
        return pd.DataFrame(
            {
                "text": [r[0] for r in rows],
                "found": [[{"kind": k, "start": a, "end": b} for k, a, b in r[1]] for r in rows],
            }
        )

    made = df.withColumn("__made", run(F.col(text), spans))
    return made.withColumns({text: F.col("__made.text"), name: F.col("__made.found")}).drop("__made")
