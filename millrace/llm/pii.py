"""Personal data: candidate spans scored by gradient-boosted trees, in DataFrame functions only.

Four base kinds (email, ip, card, phone) are found by pattern and check, and always
stay. Generators of high recall propose further spans, which may overlap: keyed and
bare secrets, local phone numbers, national numbers, account numbers and spelled-out
addresses. Each proposal gets features of its format and its context; boosted trees,
calibrated per kind by isotonic regression, score it, and the threshold of its kind
selects it. A selected span that lies within a base span or overlaps an earlier
selected one is left out; one that reaches beyond a base span stays beside it.

No table holds labels of such spans. So the trees are fitted on a fixed, seeded set of
``TRAINING_ROWS`` made-up lines with proposals of known truth; their features come from
the same expressions, and the fitted trees become one SQL expression.

Patterns are anchored and possessive, so that they need linear time and constant stack
on long texts; each finds the same spans as its plain form. Positions come from the
lengths of what a pattern matches and of what lies between.

Defined results: a null text counts as empty and has no spans; positions are code
points, ends exclusive; texts of any length are read whole; equal rows get equal spans;
an empty table gives an empty table. Other columns are carried along, except those
with the names of the outputs.
"""

from __future__ import annotations

import json
import random
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import BoostedTrees, fit_isotonic, fit_trees
from .common import free_name, let, quoted, text_or_empty

#: Kinds in the order in which spans of the same start are listed; the first four are base kinds.
KINDS = ["email", "ip", "card", "phone", "secret", "local_phone", "national_id", "account", "spelled_email"]
BASE_KINDS = 4
TRAINING_ROWS = 4000
#: Calibrated probability from which a proposal is redacted.
REDACT_FROM = 0.9
#: Characters before a proposal that count as its context.
CONTEXT = 24

# The base patterns; anchors and possessive quantifiers change no match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

SPANS = "array<struct<start:int,kind:int,end:int>>"

GENERATORS = {
    "secret": [
        r"(?i)(?<![a-z0-9])(?:password|passwd|passphrase|pwd|token|secret|api[_-]?key|access[_-]?key|private[_-]?key|bearer|auth)[\"']?[ ]{0,2}[=:][ ]{0,2}[\"']?[A-Za-z0-9+/_.=-]{6,}+[\"']?",
        r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+",
        r"(?<![A-Za-z0-9_-])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9_-])",
    ],
    "local_phone": [
        r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.-])",
        r"(?<![0-9+.-])0[1-9](?:[ .-]?[0-9]{2}){4}(?![0-9.-])",
        r"(?<![0-9+.-])\([0-9]{2,5}\) ?[0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9.-])",
        r"(?<![0-9+./-])\(?0[0-9]{2,4}\)? ?[/ -] ?[0-9]{5,8}(?![0-9.-])",
    ],
    "national_id": [
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"(?<![A-Za-z0-9-])[0-9]{8}-?[A-Z](?![A-Za-z0-9-])",
        r"(?<![0-9.-])[12] ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[0-9]{3} ?[0-9]{3}(?: ?[0-9]{2})?(?![0-9.-])",
    ],
    "account": [r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"],
    "spelled_email": [r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+[ ]?[\[({][ ]?(?i:at)[ ]?[\])}][ ]?[A-Za-z0-9-]++(?:[ ]?[\[({][ ]?(?i:dot)[ ]?[\])}][ ]?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++"],
}
#: What a text must contain to be worth the generators.
WORTH = r"[0-9]|[=:]|AKIA|ASIA|[\[({][ ]?(?i:at)[ ]?[\])}]"
KEYWORDS = {
    "secret_word": r"(?i)password|passwd|pwd|token|secret|key|credential|auth",
    "phone_word": r"(?i)phone|tel|call|fax|mobile|cell|dial|handy|numéro|teléfono",
    "id_word": r"(?i)ssn|social|iban|account|konto|compte|cuenta|passport|insurance|dni|nif|insee|sécu",
    "mail_word": r"(?i)mail|contact|write|reach",
    "other_word": r"(?i)version|build|isbn|issue|page|order|commit|file|part|sha|md5|date|http|www|item|serial|model",
}


# -- positions


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of struct(start, hit), in order."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    parts = F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"))
    empty = F.lit(None).cast("array<struct<start:int,hit:string>>")
    start = F.struct(F.lit(0).alias("at"), F.coalesce(empty, F.array().cast("array<struct<start:int,hit:string>>")).alias("found"))

    def step(acc: Column, p: Column) -> Column:
        at = acc["at"] + p["gap"]
        return F.struct((at + F.length(p["hit"])).alias("at"), F.array_append(acc["found"], F.struct(at.alias("start"), p["hit"].alias("hit"))).alias("found"))

    return F.aggregate(parts, start, step, lambda acc: acc["found"])


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is divisible by 10."""

    def add(total: Column, i: Column) -> Column:
        d = digits.substr(i, F.lit(1)).cast("int")
        twice = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
        return total + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _octets_hold(hit: Column) -> Column:
    def small(part: Column) -> Column:
        shown = F.ltrim(part, F.lit("0"))
        return F.when(F.length(shown) > 3, F.lit(False)).otherwise(F.coalesce(shown.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(hit, r"\."), small)


def _card_holds(hit: Column) -> Column:
    return let(_digits(hit), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))


def _checked(matches: Column, place: int, holds) -> Column:
    """The spans of the matches that hold."""
    return F.transform(
        F.filter(matches, lambda m: holds(m["hit"])),
        lambda m: F.struct(m["start"].alias("start"), F.lit(place).alias("kind"), (m["start"] + F.length(m["hit"])).alias("end")),
    )


def base_spans(text: Column) -> Column:
    """The spans of the base kinds, ordered by start and kind."""
    checks = {
        "email": (EMAIL, text.contains("@"), lambda h: F.lit(True)),
        "ip": (IP, text.rlike(r"[0-9]\.[0-9]"), _octets_hold),
        "card": (CARD, text.rlike(r"[0-9](?:[ -]?[0-9]){11}"), _card_holds),
        "phone": (PHONE, text.contains("+"), lambda h: F.length(_digits(h)).between(9, 15)),
    }
    found = [F.when(worth, _checked(_matches(text, pattern), KINDS.index(kind), holds)).otherwise(_none(SPANS)) for kind, (pattern, worth, holds) in checks.items()]
    return F.sort_array(F.concat(*found))


# -- proposals

FEATURES = [
    "kind",
    "length",
    "digits",
    "digit_share",
    "uppers",
    "lowers",
    "marks",
    "changes",
    "hex",
    "vowel_share",
    "assigned",
    "ends_clean",
    *KEYWORDS,
]


def _format_features(kind: Column, hit: Column, before: Column) -> dict[str, Column]:
    """Numbers that describe a proposal's own form and what stands before it."""
    size = F.length(hit)

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(hit, pattern, "")).cast("double")

    digits, uppers, lowers = left("[^0-9]"), left("[^A-Z]"), left("[^a-z]")
    flag = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    return {
        "kind": kind.cast("double"),
        "length": size.cast("double"),
        "digits": digits,
        "digit_share": digits / size,
        "uppers": uppers,
        "lowers": lowers,
        "marks": size - digits - uppers - lowers,
        # how often letters and digits change places, as random strings do
        "changes": F.length(F.regexp_replace(F.regexp_replace(hit, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])", "\u0001"), "[^\u0001]", "")).cast("double"),
        "hex": flag(hit.rlike("^[\"']?(?:[A-Za-z_]+[\"']?[ ]*[=:][ ]*[\"']?)?(?:[0-9a-f]{16,}|[0-9A-F]{16,})[\"']?$")),
        "vowel_share": left("[^aeiouAEIOU]") / size,
        "assigned": flag(hit.rlike("[=:]")),
        "ends_clean": flag(~hit.rlike("[.-]$")),
    } | {name: flag(before.rlike(pattern) | (hit.rlike(pattern) if name == "secret_word" else F.lit(False))) for name, pattern in KEYWORDS.items()}


def proposals(text: Column) -> Column:
    """Proposed spans as struct(start, kind, end, and the features)."""
    def described(place: int):
        def one(m: Column) -> Column:
            before = text.substr(F.greatest(m["start"] + 1 - CONTEXT, F.lit(1)), F.least(m["start"], F.lit(CONTEXT)))
            numbers = _format_features(F.lit(place), m["hit"], before)
            return F.struct(
                m["start"].alias("start"),
                F.lit(place).alias("kind"),
                (m["start"] + F.length(m["hit"])).alias("end"),
                *[numbers[n].cast("double").alias("f_" + n) for n in FEATURES],
            )

        return one

    found = [F.transform(_matches(text, pattern), described(KINDS.index(kind))) for kind, patterns in GENERATORS.items() for pattern in patterns]
    kinds = "array<struct<start:int,kind:int,end:int," + ",".join(f"f_{n}:double" for n in FEATURES) + ">>"
    return F.when(text.rlike(WORTH), F.concat(*found)).otherwise(_none(kinds))


# -- the model


@dataclass
class SpanModel:
    trees: BoostedTrees
    #: For each kind the margin from which a proposal is selected.
    cutoffs: dict[int, float]

    def selects(self, p: Column) -> Column:
        margin = self.trees.margin_column([p["f_" + n] for n in FEATURES])
        case = None
        for kind, cutoff in sorted(self.cutoffs.items()):
            value = F.lit(cutoff if cutoff != float("inf") else 1e300)
            case = F.when(p["kind"] == kind, value) if case is None else case.when(p["kind"] == kind, value)
        return margin >= F.coalesce(case, F.lit(1e300))


def training_lines(rows: int = TRAINING_ROWS, seed: int = 7) -> list[tuple[str, int]]:
    """Made-up lines and whether their proposals are personal data."""
    r = random.Random(seed)
    digit_heavy = "00112233445566778899abcdef"
    hexes, base = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pick = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    num = lambda n: pick("0123456789", n)
    syllables = "an be co de er fi ga he in jo ka le mo ne or pa qu re st ti un ver wi".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    words = lambda k: " ".join(word() for _ in range(k))
    phone_words = ["phone ", "tel. ", "call ", "fax: ", "mobile ", "Handy ", "tél : numéro ", "teléfono "]

    def mixed(alphabet: str, n: int) -> str:
        return num(1) + pick(alphabet, n - 3) + num(1) + pick("ABCDEFabcdef" if alphabet is not hexes else "abcdef", 1)

    yes = [
        lambda: f"{r.choice(['password', 'passwd', 'pwd', 'Password'])}{r.choice(['=', ': ', ' = '])}{mixed(r.choice([hexes, base]), r.randint(8, 24))}",
        lambda: f'{r.choice(["token", "secret", "api_key", "access_key", "apikey"])} = "{mixed(r.choice([hexes, base]), r.randint(12, 44))}"',
        lambda: r.choice(["AKIA", "ASIA"]) + pick(r.choice(["ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]), 16),
        lambda: f'{r.choice(["token", "secret", "api_key"])} = "{mixed(digit_heavy, r.randint(16, 44))}"',
        lambda: r.choice(["ghp_", "sk-", "xoxb-", ""]) + mixed(base, r.randint(24, 40)),
        lambda: mixed(hexes, r.choice([32, 40, 64])),
        lambda: f"{r.choice(['phone', 'tel', 'call', 'fax', 'mobile'])}{r.choice([': ', ' ', '. '])}({num(3)}) {num(3)}-{num(4)}",
        lambda: f"{r.choice(['phone', 'tel', 'call', 'fax', 'mobile', 'dial'])} {num(3)}{(s := r.choice('-. '))}{num(3)}{s}{num(4)}",
        lambda: f"({num(3)}) {num(3)}-{num(4)}",
        lambda: f"{num(3)}-{num(3)}-{num(4)}",
        lambda: f"{r.choice(phone_words)}0{r.choice('123456789')}" + (lambda s: "".join(s + num(2) for _ in range(4)))(r.choice([" ", ".", " ", "-"])),
        lambda: f"{r.choice([*phone_words, ''])}({num(3)}){r.choice(['', ' '])}{num(3)}-{num(4)}",
        lambda: f"{r.choice(phone_words)}0{num(r.choice([2, 3]))}{r.choice(['/', ' ', '-', ' / '])}{num(r.choice([6, 7, 8]))}",
        lambda: f"{r.choice(['SSN ', 'ssn: ', 'social security ', ''])}{num(3)}-{num(2)}-{num(4)}",
        lambda: f"{r.choice(['DNI ', 'NIF: ', 'dni '])}{num(8)}{r.choice(['', '-'])}{pick('ABCDEFGHJKLMNPQRSTVWXYZ', 1)}",
        lambda: f"{r.choice(['INSEE ', 'sécu : ', 'n° sécu '])}{r.choice('12')} {num(2)} {num(2)} {num(2)} {num(3)} {num(3)} {num(2)}",
        lambda: f"{r.choice(['IBAN ', 'account ', ''])}{r.choice(['DE', 'FR', 'ES', 'GB', 'NL'])}{num(2)}" + (lambda s: s.join(["", *[num(4) for _ in range(r.randint(3, 5))]]))(r.choice([" ", ""])),
        lambda: f"{word()}.{word()} {r.choice(['[at]', '(at)', '[ at ]'])} {word()} {r.choice(['[dot]', '(dot)'])} {r.choice(['com', 'org', 'net', 'de'])}",
        lambda: f"{word()}{num(2)} [at] {word()}.{r.choice(['com', 'org', 'example.com'])}",
    ]
    no = [
        lambda: f"{r.choice(['version', 'build', 'release'])} {num(2)}.{num(3)}.{num(3)}",
        lambda: f"{r.choice(['ISBN', 'isbn', 'order', 'item', 'part', 'page'])} {num(3)} {num(3)} {num(4)}",
        lambda: f"{num(4)} {num(4)} {num(4)}",
        lambda: " ".join(num(2) for _ in range(r.randint(5, 7))),
        lambda: f"{r.choice(['item', 'part', 'order', 'serial', 'issue'])} 0{num(r.choice([2, 3]))}{r.choice(['-', ' ', '/'])}{num(r.choice([5, 6, 7]))}",
        lambda: f"({num(3)}) {num(4)} {num(4)} {word()}" if r.random() < 0.5 else f"page ({num(3)}) {num(3)} {num(4)}",
        lambda: f"{r.choice(['model', 'part', 'serial'])} {num(8)}{pick('ABCDEFGH', 1)}",
        lambda: f"{r.choice('12')} {num(2)} {num(2)} {num(2)} {num(3)} {num(3)} items",
        lambda: f"{num(2)}.{num(3)}.{num(3)}",
        lambda: f"{num(4)}-{num(3)} {num(3)}",
        lambda: "-".join(word() for _ in range(r.randint(5, 8))) + "-" + num(r.choice([1, 2, 4])),
        lambda: "_".join(word() for _ in range(r.randint(5, 8))) + num(2),
        lambda: word() + word() + word() + word() + word() + num(r.choice([1, 2])),
        lambda: f"http www {word()}-{word()}-{word()}-{word()}-{word()}-{num(4)}",
        lambda: num(r.randint(16, 24)),
        lambda: "-".join([num(4), num(2), num(2)]) + "-" + "-".join(word() for _ in range(4)),
        lambda: f"token: {word()}{word()}{word()}",
        lambda: f"secret: {word()}{word()}{word()}",
        lambda: f"key = {word()}{word()}{word()}",
        lambda: f"auth: {word()}{word()}-{word()}",
        lambda: f"model {r.choice(['XR', 'MT', 'AB'])}{num(2)} {pick('ABCDEFGH', 4)} {pick('ABCDEFGH', 4)} {pick('ABCDEFGH', 4)}",
        lambda: f"{num(3)} {num(4)} {num(3)}",
    ]
    lines = []
    for k in range(rows):
        truth = k % 2
        made = r.choice(yes if truth else no)()
        lines.append((f"{words(r.randint(1, 5))} {made} {words(r.randint(1, 4))}.", truth))
    return lines


#: Fitted models by their parameters; the lines are seeded, so each has but one.
_FITTED: dict[tuple[int, float], SpanModel] = {}


def fit(spark: SparkSession, rows: int = TRAINING_ROWS, redact_from: float = REDACT_FROM) -> SpanModel:
    """Trees on one half of the made-up lines, cutoffs per kind from the other; fitted once a process."""
    if (rows, redact_from) in _FITTED:
        return _FITTED[rows, redact_from]
    told = json.dumps([{"text": t, "truth": y, "half": (k // 2) % 2} for k, (t, y) in enumerate(training_lines(rows))], ensure_ascii=True)
    lines = spark.range(1).select(F.inline(F.from_json(F.lit(told), "array<struct<text:string,truth:int,half:int>>")))
    # the proposals of a line share its truth
    described = lines.select("truth", "half", F.explode(proposals(F.col("text"))).alias("p")).select("truth", "half", *[F.col("p.f_" + n).alias(n) for n in FEATURES])
    got = np.array([tuple(row) for row in described.collect()], np.float64).reshape(-1, 2 + len(FEATURES))
    got = got[np.lexsort(got.T)]
    y, half, x = got[:, 0], got[:, 1], got[:, 2:]
    trees = fit_trees(x[half == 0], y[half == 0], n_trees=30)
    margin = trees.margin(x)
    cutoffs = {}
    for kind in range(BASE_KINDS, len(KINDS)):
        at = (x[:, 0] == kind) & (half == 1)
        cutoffs[kind] = fit_isotonic(margin[at], y[at]).threshold(redact_from) if at.any() else float("inf")
    _FITTED[rows, redact_from] = SpanModel(trees, cutoffs)
    return _FITTED[rows, redact_from]


# -- the operator


def _settled(base: Column, added: Column) -> Column:
    """All base spans, and the selected ones that lie in no base span and overlap no earlier selected one."""
    together = F.sort_array(F.concat(base, added))
    none = F.struct(_none(SPANS).alias("out"), F.lit(0).alias("reach"), F.lit(0).alias("base_reach"))

    def step(acc: Column, s: Column) -> Column:
        is_base = s["kind"] < BASE_KINDS
        stays = is_base | ((s["start"] >= acc["reach"]) & (s["end"] > acc["base_reach"]))
        grown = F.struct(
            F.array_append(acc["out"], s).alias("out"),
            F.when(is_base, acc["reach"]).otherwise(s["end"]).alias("reach"),
            F.when(is_base, F.greatest(acc["base_reach"], s["end"])).otherwise(acc["base_reach"]).alias("base_reach"),
        )
        return F.when(stays, grown).otherwise(acc)

    return F.aggregate(together, none, step, lambda acc: acc["out"])


OUTPUTS = ["base_spans", "spans"]


def find_spans(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """All columns with ``base_spans`` and ``spans``: arrays of struct(start, kind, end).

    ``kind`` is a place in ``KINDS``.
    """
    model = model or fit(docs.sparkSession)
    text = text_or_empty("text")
    added_name = free_name(docs, "_added")
    kept = [F.col(quoted(c)) for c in docs.columns if c.lower() not in OUTPUTS]
    added = F.transform(F.filter(proposals(text), model.selects), lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    found = docs.select(*kept, base_spans(text).alias("base_spans"), F.array_distinct(added).alias(added_name))
    return found.select(*kept, "base_spans", F.when(F.size(added_name) == 0, F.col("base_spans")).otherwise(_settled(F.col("base_spans"), F.col(added_name))).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    empty = F.struct(_none("array<struct<start:int,kind:int,end:int>>").alias("out"), F.lit(0).alias("reach"))

    def step(acc: Column, s: Column) -> Column:
        # a span that begins inside what is already covered only lengthens the last one
        last = F.element_at(acc["out"], -1)
        longer = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        fresh = F.array_append(acc["out"], s)
        joined = F.array_append(F.slice(acc["out"], 1, F.size(acc["out"]) - 1), longer)
        apart = (F.size(acc["out"]) == 0) | (s["start"] >= acc["reach"])
        return F.struct(F.when(apart, fresh).otherwise(joined).alias("out"), F.greatest(acc["reach"], s["end"]).alias("reach"))

    def rebuilt(cut: Column) -> Column:
        names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
        pieces = F.transform(cut, lambda s, k: F.concat(text.substr(F.coalesce(F.get(cut, k - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(cut, k - 1)["end"], F.lit(0))), F.get(names, s["kind"])))
        tail = text.substr(F.element_at(cut, -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    return F.when(F.size(spans) == 0, text).otherwise(let(F.aggregate(spans, empty, step, lambda acc: acc["out"]), rebuilt))


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """The documents with all found spans redacted, and all their columns.

    A null text stays null. ``n_chars``, if there, follows a text that changes.
    """
    # other columns wait inside a struct, whatever their names
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text")
    found = find_spans(held, model)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col("spans"))).alias("_text")
    out = found.select("_doc", "spans", text)

    def column(name: str) -> Column:
        given = F.col(f"_doc.`{name}`")
        if name == "text":
            return F.col("_text").alias(name)
        if name == "n_chars":
            return F.when(F.size("spans") > 0, F.length("_text").cast(docs.schema[name].dataType)).otherwise(given).alias(name)
        return given.alias(name)

    return out.select([column(c) for c in docs.columns])
