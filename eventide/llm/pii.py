"""PII: format-preserving Feistel pseudonyms, all in Spark SQL expressions.

Values are found by pattern and validated; each is replaced by a keyed
permutation of itself within its format, so equal values stay equal across
documents and nothing has to be looked up or joined:

=========  =========================================  =========================
kind       validated by                               permuted
=========  =========================================  =========================
email      address shape                              local part
iban       its country's length, mod-97 check         account part; check redone
date       a calendar day of 1900-2099                the day number
ssn        9 digits grouped 3-2-4                     all digits
phone      + country code, 7 to 12 digits in groups,  digits after the code
           or 3-3-4 groups
ip         four octets, no letter or "version"        the 32-bit address
           before them
secret     32 to 128 hexadecimal digits               all digits
card       Luhn check of 13 to 19 digits, bare or in  all digits but the last,
           groups 4-4-4-4 or 4-6-5                    which keeps the Luhn check
=========  =========================================  =========================

Strings run through a balanced Feistel network over their characters: a round
adds, to each character of one half, a keyed digest of the other half modulo
the size of the character's class (digits, lower, upper case; hexadecimal
digits for secrets).  Dates and addresses run through the same kind of network
over two numbers.

The key comes from the session setting ``KEY_SETTING`` (its name makes Spark
redact the value), unless a caller passes one; where neither is given, the
public ``KEY`` serves tests and examples and hides nothing from its readers.

Defined cases: a null text stays null with 0 replacements; a text without a
value is unchanged; values that fail validation stay as they are; repeated
rows come out alike; very long texts are handled whole, with patterns of
bounded look-behind and repetition; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_SETTING = "spark.eventide.pseudonym.secret"
KEY = "eventide-pseudonym-key"
ROUNDS = 8

# Length of an IBAN by country: the ISO 13616 registry, then those in use outside it.
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 "
    "FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
    "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
    "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30 "
    "AO25 BF28 BJ28 CF27 CG27 CI28 CM27 CV25 DZ26 GA27 GQ27 GW25 IR26 KM27 MA28 MG27 ML28 MZ25 NE28 SN28 TD27 TG28").split()}


def _iban_pattern() -> str:
    """As many characters as the country's IBANs have, so no following word is
    taken; of other countries, as many groups as there are."""
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    kinds = []
    for length, countries in sorted(by_length.items()):
        groups, rest = divmod(length - 4, 4)
        last = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        kinds.append(rf"(?:{'|'.join(countries)})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{last}")
    kinds.append(rf"(?!{'|'.join(IBAN_LENGTHS)})[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?")
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}\d{{2}})(?:{'|'.join(kinds)})(?![A-Za-z0-9])"


# Formats of the kinds (fixed values).
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "iban": _iban_pattern(),
    "iso": r"(?<![\d-])(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d-])",
    "dmy": r"(?<![\d/.])\d{1,2}([/.])\d{1,2}\1(?:19|20)\d\d(?![\d/]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])\+4[57](?:[ .-]?\d{2}){4}(?!\d)"
             r"|(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
             # Groups of two digits: 7 to 12 digits after the code; a fourth pair
             # must not begin an address, a date or a time.
             r"|(?<![\w+])\+\d{1,3}[ .-]\(?\d{1,4}\)?(?:[ .-]\d{2}(?!\d)){3}(?:[ .-]\d{2}(?!\d|[./:-]\d))?"
             r"|(?<![\w+])\+\d{1,3}[ .-]\(?\d{1,4}\)?[ .-]\d{3}(?:[ .-]\d{2}|[ .-]\d{3})[ .-]\d{2}(?!\d)"
             r"|(?<![\w(-])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?![\d-])",
    "ip": r"(?<![\w.])(?<!\b[Vv]er )(?<!\b[Vv]er\. )(?<!\b[Vv]ersion )(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,128}(?![0-9A-Za-z])",
    "card": r"(?<![\dA-Za-z])(?:\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\dA-Za-z])",
}
# Days from 1900-01-01 to 2099-12-31, as 17 x 4297.
FIRST_DAY, DAY_ROWS, DAY_COLS = "DATE'1900-01-01'", 17, 4297


def _alternatives() -> str:
    """One pattern of all kinds; back-references need no renumbering because
    only one kind has a group."""
    return "|".join(PATTERNS.values())


def _lit(text: str) -> str:
    """A SQL string literal that stands for ``text`` exactly."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digest(key: str, round_: str, place: str, half: str) -> str:
    """A keyed non-negative number below 2^48."""
    return (f"cast(conv(substr(sha2(concat_ws('|', {_lit(key)}, {round_}, {place}, {half}), 256), 1, 12), 16, 10) as bigint)")


def _shift(char: str, by: str, hexadecimal: bool) -> str:
    """Add within the character's class."""
    size = 6 if hexadecimal else 26
    return (f"case when {char} between '0' and '9' then char(48 + (ascii({char}) - 48 + {by}) % 10) "
            f"when {char} between 'a' and 'z' then char(97 + (ascii({char}) - 97 + {by}) % {size}) "
            f"when {char} between 'A' and 'Z' then char(65 + (ascii({char}) - 65 + {by}) % {size}) else {char} end")


def feistel_text(value: str, key: str, kind: str, hexadecimal: bool = False) -> str:
    """SQL that permutes the characters of ``value`` within their classes."""
    char = "substr(s.l, i, 1)"
    moved = _shift(char, _digest(key, f"concat({_lit(kind)}, k)", "i", "s.r"), hexadecimal)
    half = ("case when s.l = '' then '' else array_join(transform(sequence(1, length(s.l)), i -> "
            f"{moved}), '') end")
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', left({value}, cast(length({value}) / 2 as int)), "
            f"'r', substr({value}, cast(length({value}) / 2 as int) + 1)), "
            f"(s, k) -> named_struct('l', s.r, 'r', {half}), s -> concat(s.l, s.r))")


def feistel_pair(left: str, right: str, rows: int, cols: int, key: str, kind: str) -> str:
    """SQL for a struct (l, r): a permutation of Z_rows x Z_cols."""
    by_r = _digest(key, f"concat({_lit(kind)}, 2 * k)", "0", "s.r")
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), "
            f"(s, k) -> transform(array(named_struct('l', (s.l + {by_r}) % {rows}, 'r', s.r)), "
            f"t -> named_struct('l', t.l, 'r', (t.r + {_digest(key, f'concat({_lit(kind)}, 2 * k + 1)', '0', 't.l')}) % {cols}))[0])")


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _poured(template: str, digits: str, skip: str = "0") -> str:
    """``template`` with its digits, after the first ``skip``, replaced in order."""
    before = "length(" + _digits(f"substr({template}, 1, i)") + ")"
    return (f"array_join(transform(sequence(1, length({template})), i -> case when substr({template}, i, 1) between '0' and '9' "
            f"and {before} > {skip} then substr({digits}, {before} - {skip}, 1) else substr({template}, i, 1) end), '')")


def luhn_sum(digits: str) -> str:
    """Luhn sum of a digit string, its last digit counted once."""
    d = f"cast(substr({digits}, i, 1) as int)"
    double = f"(length({digits}) - i) % 2 = 1"
    return (f"aggregate(sequence(1, length({digits})), 0, (acc, i) -> acc + case when {double} then "
            f"{d} * 2 - case when {d} > 4 then 9 else 0 end else {d} end)")


def _card(value: str, key: str) -> str:
    """Digits but the last are permuted and the last makes the run valid again,
    so no two cards share a pseudonym.  A run that fails the check stays."""
    digits = _digits(value)
    moved = feistel_text(f"left({digits}, length({digits}) - 1)", key, "card")
    last = f"cast((10 - {luhn_sum('concat(p, 0)')} % 10) % 10 as string)"
    made = f"transform(array({moved}), p -> concat(p, {last}))[0]"
    return (f"case when {luhn_sum(digits)} % 10 = 0 then transform(array({made}), n -> {_poured(value, 'n')})[0] "
            f"else {value} end")


def _mod97(value: str) -> str:
    """Remainder of an IBAN rearranged (account part first), letters as 10-35."""
    c = f"substr({value}, i, 1)"
    return (f"aggregate(sequence(1, length({value})), cast(0 as bigint), (acc, i) -> case when {c} between '0' and '9' "
            f"then (acc * 10 + ascii({c}) - 48) % 97 else (acc * 100 + ascii({c}) - 55) % 97 end)")


def _iban(value: str, key: str) -> str:
    """Groups are kept; an IBAN whose check fails stays."""
    flat = f"replace({value}, ' ', '')"
    body = feistel_text("substr(f, 5)", key, "iban")
    check = f"lpad(cast(98 - {_mod97('concat(b, left(f, 2), 0, 0)')} as string), 2, '0')"
    made = f"transform(array({body}), b -> concat(left(f, 2), {check}, b))[0]"
    spaced = (f"array_join(transform(sequence(1, length({value})), i -> case when substr({value}, i, 1) = ' ' then ' ' else "
              f"substr(g, length(replace(substr({value}, 1, i), ' ', '')), 1) end), '')")
    right = f"{_mod97('concat(substr(f, 5), left(f, 4))')} = 1"
    return (f"transform(array({flat}), f -> case when {right} then transform(array({made}), g -> {spaced})[0] else {value} end)[0]")


def _date(value: str, text_format: str, key: str) -> str:
    """A real day of the range is moved; anything else stays."""
    day = f"datediff(try_to_timestamp({value}, {_lit(text_format)}), {FIRST_DAY})"
    pair = feistel_pair(f"cast(d / {DAY_COLS} as int)", f"d % {DAY_COLS}", DAY_ROWS, DAY_COLS, key, "date")
    made = (f"transform(array({pair}), p -> date_format(date_add({FIRST_DAY}, cast(p.l * {DAY_COLS} + p.r as int)), "
            f"{_lit(text_format)}))[0]")
    return f"transform(array({day}), d -> case when d between 0 and {DAY_ROWS * DAY_COLS - 1} then {made} else {value} end)[0]"


def _dmy(value: str, key: str) -> str:
    branches = []
    for sep in "/.":
        for day, month, width in (("dd", "MM", 2), ("d", "M", 1)):
            shape = rf"^\d\d[{sep}]\d\d[{sep}]" if width == 2 else rf"^\d+[{sep}]"
            for form in (f"{day}{sep}{month}{sep}yyyy", f"{month}{sep}{day}{sep}yyyy"):
                branches.append(f"when {value} rlike {_lit(shape)} and try_to_timestamp({value}, {_lit(form)}) is not null "
                                f"then {_date(value, form, key)}")
    return "case " + " ".join(branches) + f" else {value} end"


def _phone(value: str, key: str) -> str:
    code = f"case when {value} like '+%' then length(regexp_extract({value}, '^[+]([0-9]{{1,3}})(?=[^0-9])', 1)) else 0 end"
    moved = feistel_text("n", key, "phone")
    poured = _poured(value, "m", "c")
    return (f"transform(array({code}), c -> transform(array(substr({_digits(value)}, c + 1)), n -> "
            f"transform(array({moved}), m -> {poured})[0])[0])[0]")


def _ip(value: str, key: str) -> str:
    octet = lambda i: f"cast(split({value}, '[.]')[{i}] as bigint)"
    pair = feistel_pair(f"{octet(0)} * 256 + {octet(1)}", f"{octet(2)} * 256 + {octet(3)}", 65536, 65536, key, "ip")
    return f"transform(array({pair}), p -> concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256))[0]"


def _email(value: str, key: str) -> str:
    local = feistel_text("u", key, "email")
    return f"transform(array(substring_index({value}, '@', 1)), u -> concat({local}, substr({value}, length(u) + 1)))[0]"


def pseudonym(value: str, key: str = KEY) -> str:
    """SQL for the pseudonym of one found value."""
    whole = lambda kind: f"{value} rlike {_lit('^(?:' + PATTERNS[kind] + ')$')}"
    ssn = f"transform(array({feistel_text(_digits(value), key, 'ssn')}), n -> {_poured(value, 'n')})[0]"
    made = {
        "email": _email(value, key), "iban": _iban(value, key), "iso": _date(value, "yyyy-MM-dd", key),
        "dmy": _dmy(value, key), "ssn": ssn, "phone": _phone(value, key), "ip": _ip(value, key),
        "secret": feistel_text(value, key, "secret", hexadecimal=True), "card": _card(value, key),
    }
    return "case " + " ".join(f"when {whole(kind)} then {sql}" for kind, sql in made.items()) + f" else {value} end"


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting, or the public one where it is unset."""
    return spark.conf.get(KEY_SETTING, KEY)


def with_pseudonyms(docs: DataFrame, key: str | None = None) -> DataFrame:
    """docs with ``ev_text``, the text with values replaced, and ``ev_found``,
    an array of structs (value, pseudonym) in text order."""
    key = session_key(docs.sparkSession) if key is None else key
    text = F.col("text").cast("string")
    # A value holds a digit or an "@", or is a secret of letters; most texts hold
    # none of these and are not searched.
    likely = text.rlike("[0-9@]|[A-Fa-f]{32}")
    pattern = F.lit(_alternatives())
    found = F.when(likely, F.regexp_extract_all(text, pattern, F.lit(0)))
    df = docs.withColumn("ev_values", found)
    df = df.withColumn("ev_found", F.expr(f"transform(ev_values, v -> named_struct('value', v, 'pseudonym', {pseudonym('v', key)}))"))
    gaps = F.split(text, _alternatives(), -1)
    joined = F.array_join(F.zip_with(gaps, F.col("ev_found.pseudonym"), lambda g, p: F.concat(g, F.coalesce(p, F.lit("")))), "")
    return df.withColumn("ev_text", F.when(F.size("ev_found") > 0, joined).otherwise(text)).drop("ev_values")


def pseudonymised(docs: DataFrame, key: str | None = None) -> DataFrame:
    """docs with its text column replaced (and ``n_chars``, where there is one,
    set to the new length of changed texts); other columns as they are."""
    df = with_pseudonyms(docs, key)
    made = {"text": F.col("ev_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        made["n_chars"] = F.when(F.size("ev_found") > 0, F.length("ev_text").cast(kind)).otherwise(F.col("n_chars"))
    return df.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, key: str | None = None) -> DataFrame:
    """(doc_id, text, n_replaced): every text with its values replaced."""
    df = with_pseudonyms(docs.select("doc_id", "text"), key)
    changed = F.size(F.filter(F.coalesce(F.col("ev_found"), F.array().cast("array<struct<value:string,pseudonym:string>>")),
                              lambda x: x["value"] != x["pseudonym"]))
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ev_text").alias("text"), changed.alias("n_replaced"))

