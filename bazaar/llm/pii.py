"""Pseudonyms for personal data that keep the format: keyed Feistel permutations in SQL expressions.

Numbers and dates are validated and then replaced through a keyed permutation of their format's whole
domain: equal values get equal pseudonyms in all documents, different values never collide, and the
key holder can invert the map. Addresses and secrets have no numeric domain; they get a keyed digest
in their format. Only DataFrame functions are used.

kind      found                                                    pseudonym
card      13 to 19 digits (groups by blank or hyphen), Luhn valid  digits before the check digit permuted, check digit renewed
          (whole groups anywhere in a run of groups, so an expiry, check code or number beside a card doesn't hide it)
phone     + country code and 6 to 12 digits in the usual groups    digits after the country code permuted
ip        four octets 0 to 255                                     permutation of 256**4
date      y-m-d, y/m/d and d.m.y dates that exist, 1800 to 2199    permutation of the 146,097 days of the 400-year cycle
email     local@domain                                             keyed digest at a reserved domain
secret    32, 40 or 64 hexadecimal digits                          keyed digest of the same length and case

The text between values is kept byte for byte. A digit run that is no valid number stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.shared import free_names

KEY = "bazaar-demo-key"
ROUNDS = 6

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_YEAR = r"(?:18|19|20|21)[0-9]{2}"
_OTHERS = {
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})(?![0-9A-Za-z])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "date": rf"(?<![0-9./-])(?:{_YEAR}-[0-9]{{2}}-[0-9]{{2}}|{_YEAR}/[0-9]{{2}}/[0-9]{{2}}|[0-9]{{2}}\.[0-9]{{2}}\.{_YEAR})(?![0-9]|[./-][0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9])",
}
_GROUP = r"[0-9]++(?![A-Za-z]|\.[0-9])"
#: in order of precedence at the same place; a card's pattern is the whole run of digit groups up to the next value of another kind
PATTERNS = _OTHERS | {"card": rf"(?<![0-9A-Za-z.+-])(?=[0-9](?:[ -]?[0-9]){{12}}){_GROUP}(?:[ -](?!{'|'.join(f'(?:{p})' for p in _OTHERS.values())}){_GROUP})*+"}
KINDS = tuple(PATTERNS)
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _let(value: Column, f) -> Column:
    """Bind a value once: a lambda over a one-element array, so that its expression isn't repeated."""
    return F.transform(F.array(value), f)[0]


def keyed_number(key: str, label: str, value: Column) -> Column:
    """A keyed 60-bit pseudo-random number."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{key}/{label}/"), value, F.lit(f"/{key}")), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: str, label: Column | None = None) -> Column:
    """Permutes Z_a x Z_b: rounds add a keyed function of one half to the other, modulo its size.

    Exact for any a and b, so no value leaves the domain and none is met twice. Returns struct(l, r)."""
    tag = F.lit("") if label is None else F.concat(label, F.lit(":"))
    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def shifted(s, to, by, size, i):
        return F.pmod(s[to] + F.pmod(keyed_number(key, f"{kind}/{i}", F.concat(tag, s[by].cast("string"))), size), size).alias(to)

    def one_round(i):
        return (lambda s: F.struct(s["l"].alias("l"), shifted(s, "r", "l", b, i))) if i % 2 else (lambda s: F.struct(shifted(s, "l", "r", a, i), s["r"].alias("r")))

    for i in range(ROUNDS):
        state = _let(state, one_round(i))
    return state


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """Permutes the decimal strings of the same length (2 to 36 digits)."""
    def on(d):
        n = F.length(d)
        h = F.floor(n / 2).cast("int")
        size = lambda k: F.rpad(F.lit("1"), k + 1, F.lit("0")).cast("long")
        state = feistel(F.substr(d, F.lit(1), h).cast("long"), F.substr(d, h + 1, n).cast("long"), size(h), size(n - h), key, kind, n.cast("string"))
        return _let(state, lambda s: F.concat(F.lpad(s["l"].cast("string"), h, F.lit("0")), F.lpad(s["r"].cast("string"), n - h, F.lit("0"))))
    return _let(digits, on)


def only_digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def refill(template: Column, digits: Column) -> Column:
    """Put ``digits`` in turn in place of the digits of ``template``."""
    parts = F.split(template, "[0-9]", -1)
    return F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.substr(digits, i + 1, F.lit(1)))), "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes payload + digit valid."""
    worth = F.transform(F.split(F.reverse(payload), ""), lambda x, i: F.when(i % 2 == 0, F.when(x >= "5", x.cast("int") * 2 - 9).otherwise(x.cast("int") * 2)).otherwise(x.cast("int")))
    return F.pmod(F.lit(0) - F.aggregate(worth, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))), F.lit(10)).cast("string")


#: issuers' first digits: a card in groups starts with them
_ISSUER = r"^(?:4|5[0-8]|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)|3(?:[47689]|0[0-59]|5(?:2[89]|[3-8]))|6(?:011|[2357]|4[4-9]))"
#: how cards are written: these are taken before other groups that happen to be Luhn valid
_USUAL = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})$"


def card_pseudonym(v: Column, key: str) -> Column:
    """Unchanged unless the number is Luhn valid."""
    def on(d):
        n = F.length(d)
        new = _let(permute_digits(F.substr(d, F.lit(1), n - 1), key, "card"), lambda p: F.concat(p, luhn_digit(p)))
        return F.when(luhn_digit(F.substr(d, F.lit(1), n - 1)) == F.substr(d, n, F.lit(1)), refill(v, new)).otherwise(v)
    return _let(only_digits(v), on)


def _card_ends(groups: Column, i: Column) -> Column:
    """struct(usual, any): how many groups the longest card from group ``i`` has (0: none), among the usual forms and among all."""
    def valid(k):
        def on(t):
            d = only_digits(t)
            n = F.length(d)
            # in groups: an issuer's number, in a usual form or in groups of three digits at least
            form = ~t.rlike("[ -]") | d.rlike(_ISSUER) & (t.rlike(_USUAL) | ~t.rlike("(?:^|[ -])[0-9]{1,2}(?:[ -]|$)"))
            fits = F.when(n.between(13, 19) & form, luhn_digit(F.substr(d, F.lit(1), n - 1)) == F.substr(d, n, F.lit(1))).otherwise(F.lit(False))
            return F.when(fits, F.struct(F.when(t.rlike(_USUAL), k).otherwise(0).alias("usual"), k.alias("any")))
        return _let(F.regexp_replace(F.array_join(F.slice(groups, i, k), ""), "[ -]$", ""), on)
    ends = F.transform(F.sequence(F.lit(1), F.least(F.lit(6), F.size(groups) - i + 1)), valid)  # groups of three: six of them
    started = F.element_at(groups, i).rlike(r"^[0-9]{13}|^(?:[2-6][0-9]{2})")  # where no card can start, nothing is tried
    return F.when(~started, F.struct(F.lit(0).alias("usual"), F.lit(0).alias("any"))).otherwise(_let(ends, lambda e: F.struct(F.coalesce(F.array_max(F.transform(e, lambda x: x["usual"])), F.lit(0)).alias("usual"), F.coalesce(F.array_max(F.transform(e, lambda x: x["any"])), F.lit(0)).alias("any"))))


def cards_in_run(v: Column, key: str) -> Column:
    """struct(text, cards): a run of digit groups with every card in it replaced, and the pseudonyms in order.

    From the left, the longest run of whole groups that is a Luhn valid number of an issuer is a card; a usual form goes before
    another that starts earlier and overlaps it. A number without groups needs no issuer. A run with more groups beside its
    cards than an expiry date, a check code and a few numbers make (two, and two a card) is a table of numbers and stays."""
    def on(groups):
        def scan(ends):
            def step(s, i):
                e = F.element_at(ends, i)
                # numbers of no usual form stay apart from a usual one inside them
                free = ~F.exists(F.slice(ends, i, F.greatest(e["any"], F.lit(1))), lambda x: x["usual"] > 0)
                k = F.when(i < s["next"], F.lit(-1)).when(e["usual"] > 0, e["usual"]).when((e["any"] > 0) & free, e["any"]).otherwise(F.lit(0))

                def put(n):
                    def swap(t):
                        bare = F.regexp_replace(t, "[ -]$", "")
                        return _let(card_pseudonym(bare, key), lambda c: F.struct((i + n).alias("next"), F.concat(s["out"], F.array(F.concat(c, F.substr(t, F.length(bare) + 1, F.lit(1))))).alias("out"),
                                                                                  F.when((n > 0) & (c != bare), F.concat(s["cards"], F.array(c))).otherwise(s["cards"]).alias("cards")))
                    whole = F.struct((i + 1).alias("next"), F.concat(s["out"], F.array(F.element_at(groups, i))).alias("out"), s["cards"].alias("cards"))
                    return F.when(n < 0, s).when(n == 0, whole).otherwise(_let(F.array_join(F.slice(groups, i, n), ""), swap))
                return _let(k, put)
            none = F.array().cast("array<string>")
            return F.aggregate(F.sequence(F.lit(1), F.size(groups)), F.struct(F.lit(1).alias("next"), none.alias("out"), none.alias("cards")), step)
        return _let(F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: _card_ends(groups, i)), scan)
    def judged(s):
        # groups that are in no card: each is an item of its own, as each card is
        beside = F.size(s["out"]) - F.size(s["cards"])
        return F.when(beside <= 2 + 2 * F.size(s["cards"]), F.struct(F.array_join(s["out"], "").alias("text"), s["cards"].alias("cards"))).otherwise(F.struct(v.alias("text"), F.array().cast("array<string>").alias("cards")))
    return _let(_let(F.split(v, "(?<=[ -])", -1), on), judged)


def phone_pseudonym(v: Column, key: str) -> Column:
    """The country code stays: the digits up to the first separator, or the first digit alone."""
    code = F.regexp_extract(v, r"^(\+[0-9]{1,3}(?=[ .(-])|\+[0-9])", 1)
    return _let(code, lambda c: _let(F.substr(v, F.length(c) + 1, F.length(v)), lambda r: F.concat(c, refill(r, permute_digits(only_digits(r), key, "phone")))))


def ip_pseudonym(v: Column, key: str) -> Column:
    def on(o):
        k = F.lit(65536).cast("long")
        state = feistel(o[0].cast("long") * 256 + o[1].cast("long"), o[2].cast("long") * 256 + o[3].cast("long"), k, k, key, "ip")
        return _let(state, lambda s: F.concat_ws(".", *[x.cast("long").cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)]))
    return _let(F.split(v, r"\."), on)


#: 400 Gregorian years have 146,097 = 189 x 773 days
CYCLE_START, CYCLE_A, CYCLE_B = "1800-01-01", 189, 773


def date_pseudonym(v: Column, key: str) -> Column:
    """Unchanged unless the date exists."""
    dotted, slashed = F.contains(v, F.lit(".")), F.contains(v, F.lit("/"))
    iso = F.when(dotted, F.concat_ws("-", F.substring(v, 7, 4), F.substring(v, 4, 2), F.substring(v, 1, 2))).otherwise(F.translate(v, "/", "-"))
    start = F.lit(CYCLE_START).cast("date")
    a, b = F.lit(CYCLE_A).cast("long"), F.lit(CYCLE_B).cast("long")

    def on(n):
        state = feistel(F.floor(n / CYCLE_B), n % CYCLE_B, a, b, key, "date")
        new = _let(state, lambda s: F.date_add(start, (s["l"] * CYCLE_B + s["r"]).cast("int")))
        form = F.when(dotted, F.date_format(new, "dd.MM.yyyy")).when(slashed, F.date_format(new, "yyyy/MM/dd")).otherwise(F.date_format(new, "yyyy-MM-dd"))
        return F.when(n.isNull(), v).otherwise(form)
    return _let(F.datediff(iso.try_cast("date"), start).cast("long"), on)


def _digest(v: Column, key: str, kind: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}/{kind}/"), v, F.lit(f"/{key}")), 256)


def email_pseudonym(v: Column, key: str) -> Column:
    """Case does not count."""
    return _let(_digest(F.lower(v), key, "email"), lambda h: F.concat(F.lit("u"), F.substring(h, 1, 20), F.lit("@example.invalid")))


def secret_pseudonym(v: Column, key: str) -> Column:
    low = F.substr(_digest(F.lower(v), key, "secret"), F.lit(1), F.length(v))
    return F.when(v == F.upper(v), F.upper(low)).otherwise(low)


def kind_of(v: Column) -> Column:
    """The first kind whose pattern matches the whole value."""
    out = F.when(F.contains(v, F.lit("@")), "email").when(v.rlike("^(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})$"), "secret")
    out = out.when(v.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip").when(F.startswith(v, F.lit("+")), "phone")
    return out.when(v.rlike(r"^(?:[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})$"), "date").otherwise("card")


def pseudonym(v: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value that isn't a card."""
    return (F.when(kind == "email", email_pseudonym(v, key)).when(kind == "secret", secret_pseudonym(v, key)).when(kind == "ip", ip_pseudonym(v, key))
            .when(kind == "phone", phone_pseudonym(v, key)).otherwise(date_pseudonym(v, key)))


def swap(v: Column, kind: Column, key: str) -> Column:
    """struct(text, found): what replaces a match, and the pseudonyms in it (none where nothing changes, several in a run of cards)."""
    none = F.array().cast("array<string>")
    one = _let(pseudonym(v, kind, key), lambda p: F.struct(p.alias("text"), F.when(p != v, F.array(p)).otherwise(none).alias("found")))
    return F.when(kind == "card", _let(cards_in_run(v, key), lambda c: F.struct(c["text"].alias("text"), c["cards"].alias("found")))).otherwise(one)


def pseudonymise(docs: DataFrame, key: str = KEY, text_col: str = "text", found_col: str = "pii") -> DataFrame:
    """Replace the values in ``text_col``; ``found_col`` lists them as struct(kind, pseudonym) in order.

    Values that fail validation (card, date) stay and are not listed. Null text stays null with an
    empty list, empty text stays empty. Rows are independent: repeated rows give repeated results. A column
    named like ``found_col`` is replaced; all other columns stay."""
    text = F.col(text_col)
    values = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    swapped = F.transform(values, lambda v: _let(kind_of(v), lambda k: _let(swap(v, k, key), lambda s: F.struct(k.alias("kind"), s["text"].alias("pseudonym"), s["found"].alias("found")))))
    own, = free_names(docs.columns, "_swaps")
    out = docs.withColumn(own, swapped)
    parts = F.split(text, ANY, -1)
    joined = F.array_join(F.zip_with(parts, F.col(f"{own}.pseudonym"), lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")
    listed = F.flatten(F.transform(own, lambda s: F.transform(s["found"], lambda p: F.struct(s["kind"].alias("kind"), p.alias("pseudonym")))))
    return (out.withColumn(text_col, F.when(F.size(own) > 0, joined).otherwise(text))
            .withColumn(found_col, F.coalesce(listed, F.array().cast("array<struct<kind:string,pseudonym:string>>"))).drop(own))
