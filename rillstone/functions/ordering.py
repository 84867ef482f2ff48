"""The order of values of any type, as text that sorts like the document database sorts them.

Values are VARIANT. The first two characters are the bracket of a value's type; what follows sorts within it.
Numbers of all types are one bracket. Objects and arrays are ordered by their text among themselves.
Ids, dates and numbers that JSON cannot hold are objects of one field, as in extended JSON: $oid, $date, $numberLong,
$numberDecimal, $numberDouble.
"""

from __future__ import annotations

import json
import math
import operator
from collections.abc import Callable
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal, localcontext
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Brackets by the types' names, in the database's order.
BRACKETS = {"null": "10", "number": "20", "string": "30", "object": "40", "array": "50", "objectId": "60", "bool": "70", "date": "80"}
DIGITS, COMPLEMENT = "0123456789", "9876543210"
#: Added to exponents and to milliseconds, so that their text sorts.
EXPONENT, MILLIS = 5000, 1 << 62


def field(v: Column, name: str, kind: str = "variant") -> Column:
    """A field of an object; null if v is none, lacks it, or cannot be read as that type."""
    return F.try_variant_get(v, F.lit(f"$['{name}']"), kind)


def items(v: Column) -> Column:
    """The elements of an array; null if v is none."""
    return F.try_variant_get(v, F.lit("$"), "array<variant>")


def _text(v: Column, kind: str = "string") -> Column:
    return F.try_variant_get(v, F.lit("$"), kind)


def _fixed(n: Column) -> Column:
    """Digits of a decimal that is not negative: 20 before the point, 18 after it."""
    whole = F.floor(n).cast("decimal(20,0)")
    rest = ((n - whole) * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(18,0)")
    return F.concat(F.lpad(whole.cast("string"), 20, "0"), F.lpad(rest.cast("string"), 18, "0"))


def _floating(d: Column) -> Column:
    """Exponent and digits of a double above zero."""
    shown = F.format_string("%.18e", d)
    exponent = F.lpad((F.substring_index(shown, "e", -1).cast("int") + EXPONENT).cast("string"), 4, "0")
    return F.concat(exponent, F.translate(F.substring_index(shown, "e", 1), ".", ""))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _number(exact: Column, double: Column) -> Column:
    """Text that sorts by value, of a number as a decimal (null: too large for one) and as a double; of negative ones complemented."""
    inf = float("inf")

    def body(x: Column, d: Column) -> Column:
        size = F.abs(d)
        return F.when(x.isNull(), F.concat(F.lit("9"), _floating(size))).when((x == 0) & (size > 0), F.concat(F.lit("1"), _floating(size))).otherwise(F.concat(F.lit("5"), _fixed(F.abs(x))))

    def signed(n: Column) -> Column:
        x, d = n["x"], n["d"]
        return F.when(F.isnan(d), "0").when(d == -inf, "1").when(d == inf, "5").when(d == 0, "3").when(d > 0, F.concat(F.lit("4"), body(x, d))).otherwise(F.concat(F.lit("2"), F.translate(body(x, d), DIGITS, COMPLEMENT)))

    return let(F.struct(exact.alias("x"), double.alias("d")), signed)


def _boxed(v: Column) -> Column:
    return F.coalesce(*[field(v, f"$number{n}", "string") for n in ("Long", "Decimal", "Double", "Int")])


def _bracket(v: Column, kind: Column) -> Column:
    """The bracket of a value whose type (as schema_of_variant names it) is known."""
    extended = F.when(field(v, "$oid", "string").isNotNull(), BRACKETS["objectId"]).when(field(v, "$date").isNotNull(), BRACKETS["date"]).when(_boxed(v).isNotNull(), BRACKETS["number"]).otherwise(BRACKETS["object"])
    return F.when(kind.isNull() | (kind == "VOI"), BRACKETS["null"]).when(kind == "STR", BRACKETS["string"]).when(kind == "OBJ", extended).when(kind == "ARR", BRACKETS["array"]).when(kind == "BOO", BRACKETS["bool"]).otherwise(BRACKETS["number"])


def kind_of(v: Column) -> Column:
    """The first letters of a value's type; null if it is missing. Whole numbers are BIG."""
    return F.substring(F.schema_of_variant(v), 1, 3)


def bracket(v: Column) -> Column:
    """The bracket of a value; a missing one counts as null."""
    return let(kind_of(v), lambda kind: _bracket(v, kind))


def _whole(shown: Column) -> Column:
    """What _number makes of a whole number of 64 bits, from its digits."""
    digits, zeros = F.lpad(F.ltrim(shown, F.lit("-")), 20, "0"), "0" * 18
    below = F.concat(F.lit("24"), F.translate(digits, DIGITS, COMPLEMENT), F.lit(zeros.translate(str.maketrans(DIGITS, COMPLEMENT))))
    return F.when(shown == "0", "3").when(F.startswith(shown, F.lit("-")), below).otherwise(F.concat(F.lit("45"), digits, F.lit(zeros)))


def plainly_encoded(shown: Column) -> Column:
    """encoded of a value by its JSON text, if that is a number of at most 18 digits without a point, a string without escapes or a boolean; else null.

    It has no lambda functions, which are interpreted: all of it is compiled.
    """
    first = F.substring(shown, 1, 1)
    text = F.when(~F.contains(shown, F.lit("\\")), F.concat(F.lit(BRACKETS["string"]), F.substring(shown, F.lit(2), F.length(shown) - 2)))
    number = F.when((F.translate(shown, DIGITS + "-", "") == "") & (F.length(shown) <= 18), F.concat(F.lit(BRACKETS["number"]), _whole(shown)))
    return F.when(first == '"', text).when(first == "t", BRACKETS["bool"] + "1").when(first == "f", BRACKETS["bool"] + "0").when(first.isin(*DIGITS, "-"), number)


def encoded(v: Column) -> Column:
    """Text that sorts like values do, and is equal for equal ones; a missing value is like null.

    Numbers are exact with up to 20 digits before the point and 18 after it; beyond that they count as doubles.
    """
    plain = _number(_text(v, "decimal(38,18)"), _text(v, "double"))
    boxed = let(_boxed(v), lambda n: _number(n.try_cast("decimal(38,18)"), n.try_cast("double")))
    date = field(v, "$date")
    millis = F.coalesce(F.try_variant_get(date, F.lit("$['$numberLong']"), "string").cast("bigint"), F.unix_millis(_text(date, "string").try_cast("timestamp")))

    def other(kind: Column) -> Column:
        def body(b: Column) -> Column:
            value = (
                F.when(b == BRACKETS["number"], F.when(kind == "OBJ", boxed).otherwise(plain)).when(b == BRACKETS["bool"], F.when(_text(v, "boolean"), "1").otherwise("0")).when(b == BRACKETS["null"], "")
                .when(b == BRACKETS["objectId"], F.lower(field(v, "$oid", "string"))).when(b == BRACKETS["date"], F.lpad((millis + F.lit(MILLIS)).cast("string"), 19, "0")).otherwise(F.to_json(v))
            )
            return F.concat(b, F.coalesce(value, F.lit("")))

        return let(_bracket(v, kind), body)

    def of(kind: Column) -> Column:
        whole = let(_text(v), lambda shown: F.concat(F.lit(BRACKETS["number"]), _whole(shown)))
        return F.when(kind == "BIG", whole).when(kind == "STR", F.concat(F.lit(BRACKETS["string"]), _text(v))).otherwise(other(kind))

    return let(kind_of(v), of)


_TESTS: dict[str, Callable[[Any, Any], Any]] = {"$eq": operator.eq, "$gt": operator.gt, "$gte": operator.ge, "$lt": operator.lt, "$lte": operator.le}


def _against_whole(n: Column, op: str, want: Decimal) -> Column:
    """A whole number of 64 bits compared with any finite number."""
    bound = math.ceil(want) if op in ("$gte", "$lt") else math.floor(want)
    if op == "$eq" and bound != want:
        return F.lit(False)
    if not -(1 << 63) <= bound < 1 << 63:
        return F.lit(_TESTS[op](0, bound))
    return _TESTS[op](n, F.lit(bound).cast("bigint"))


def compared(v: Column, op: str, want: Any) -> Column:
    """Whether a value has want's bracket and stands to it as op says, never null.

    The same as comparing the encoded texts; numbers, strings and booleans are compared as what they are, which is far
    cheaper. What is neither (numbers that are objects, or too large or small for a decimal) is encoded.
    """
    bound, test = encoded_constant(want), _TESTS[op]
    wanted = bound[:2]
    number = _decimal(want) if wanted == BRACKETS["number"] else None

    def quick(kind: Column) -> Column:
        """Null where only the encoded text tells."""
        if wanted == BRACKETS["number"]:
            other = kind.isin("BIG", "DEC", "DOU", "FLO")
            if number is not None:
                exact = let(_text(v, "decimal(38,18)"), lambda d: F.when(d != 0, test(d, F.lit(number).cast("decimal(38,18)"))))
                return F.when(kind == "BIG", _against_whole(_text(v, "bigint"), op, number)).when(kind.isin("DEC", "DOU", "FLO"), exact).when((kind == "OBJ") & _boxed(v).isNotNull(), None).otherwise(False)
            return F.when(other | ((kind == "OBJ") & _boxed(v).isNotNull()), None).otherwise(False)
        if wanted == BRACKETS["string"]:
            return F.when(kind == "STR", test(_text(v), F.lit(want))).otherwise(False)
        if wanted == BRACKETS["bool"]:
            return F.when(kind == "BOO", test(_text(v, "boolean"), F.lit(want))).otherwise(False)
        if wanted == BRACKETS["objectId"]:
            return F.when(kind == "OBJ", F.coalesce(test(F.lower(field(v, "$oid", "string")), F.lit(bound[2:])), F.lit(False))).otherwise(False)
        if wanted == BRACKETS["date"]:
            millis = F.try_variant_get(v, F.lit("$['$date']['$numberLong']"), "bigint")
            return F.when(kind != "OBJ", False).when(field(v, "$oid", "string").isNotNull(), False).when(field(v, "$date").isNull(), False).otherwise(test(millis, F.lit(int(bound[2:]) - MILLIS).cast("bigint")))
        return F.when((kind != "OBJ") if wanted == BRACKETS["object"] else F.lit(False), False)

    def slow(e: Column) -> Column:
        return F.startswith(e, F.lit(wanted)) & test(e, F.lit(bound))

    fast = let(kind_of(v), lambda kind: F.when(kind.isNull() & F.lit(wanted != BRACKETS["null"]), False).otherwise(quick(kind)))
    if wanted in (BRACKETS["string"], BRACKETS["bool"], BRACKETS["objectId"]):
        return fast
    return F.coalesce(fast, F.exists(F.array(encoded(v)), slow))


def among(v: Column, wanted: list[Any]) -> Column:
    """Whether a value equals one of wanted, never null."""
    if len(wanted) <= 4:
        return reduce(lambda a, b: a | b, [compared(v, "$eq", w) for w in wanted], F.lit(False))
    bounds = [encoded_constant(w) for w in wanted]
    numbers = [_decimal(w) for w, b in zip(wanted, bounds, strict=True) if b[:2] == BRACKETS["number"]]
    whole = [int(n) for n in numbers if n is not None and n == int(n) and -(1 << 63) <= n < 1 << 63]
    texts = [w for w, b in zip(wanted, bounds, strict=True) if b[:2] == BRACKETS["string"]]

    def of(kind: Column) -> Column:
        return F.when(kind == "BIG", _text(v, "bigint").isin(*whole) if whole else False).when(kind == "STR", _text(v).isin(*texts) if texts else False).otherwise(encoded(v).isin(*bounds))

    return F.exists(F.array(kind_of(v)), of)


def _decimal(value: Any) -> Decimal | None:
    """A number of a query as it is encoded, if a decimal(38,18) holds it; None if it is none, or zero only when rounded."""
    boxed = next((value[k] for k in value if k.startswith("$number")), None) if isinstance(value, dict) else value
    d = Decimal(str(boxed))
    if d.is_nan() or d.is_infinite() or abs(d) >= Decimal(10) ** 20:
        return None
    with localcontext(prec=60):
        exact = d.quantize(Decimal(1).scaleb(-18), ROUND_HALF_UP)
    return None if exact == 0 != d or abs(exact) >= Decimal(10) ** 20 else exact


def encoded_constant(value: Any) -> str:
    """The same of a value of a query: JSON in Python's types."""
    if value is None:
        return BRACKETS["null"]
    if isinstance(value, bool):
        return BRACKETS["bool"] + str(int(value))
    if isinstance(value, str):
        return BRACKETS["string"] + value
    if isinstance(value, dict) and "$oid" in value:
        return BRACKETS["objectId"] + value["$oid"].lower()
    if isinstance(value, dict) and "$date" in value:
        at = value["$date"]
        millis = int(at["$numberLong"]) if isinstance(at, dict) else round(datetime.fromisoformat(at).timestamp() * 1000)
        return BRACKETS["date"] + str(millis + MILLIS).rjust(19, "0")
    boxed = next((value[k] for k in value if k.startswith("$number")), None) if isinstance(value, dict) else None
    if boxed is None and isinstance(value, (dict, list)):
        return BRACKETS["object" if isinstance(value, dict) else "array"] + json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    d = Decimal(str(value) if boxed is None else boxed)
    if d.is_nan() or d.is_infinite() or d == 0:
        return BRACKETS["number"] + ("0" if d.is_nan() else "3" if d == 0 else "5" if d > 0 else "1")
    with localcontext(prec=60):
        size = abs(d)
        exact = size.quantize(Decimal(1).scaleb(-18), ROUND_HALF_UP) if size < Decimal(10) ** 20 else size
        digits, _, exponent = f"{Decimal(repr(float(size))):.18e}".partition("e")
        floating = str(int(exponent) + EXPONENT).rjust(4, "0") + digits.replace(".", "")
        body = "9" + floating if size >= Decimal(10) ** 20 else "1" + floating if exact == 0 else "5" + str(exact.scaleb(18).to_integral_value()).rjust(38, "0")
    return BRACKETS["number"] + ("4" + body if d > 0 else "2" + body.translate(str.maketrans(DIGITS, COMPLEMENT)))
