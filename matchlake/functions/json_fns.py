"""JSON helpers with warehouse semantics.

Documents are parsed once per row with a declared schema (``from_json``);
the helpers below cover the cases a typed parse does not express directly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.schemas import MATCH_DOCUMENT


#: Parser limits beyond any document, so that none is lost for its size or shape.
_NO_LIMITS = {"maxStringLen": str(2**31 - 1), "maxNestingDepth": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_document(text: Column | str, schema: T.DataType = MATCH_DOCUMENT) -> Column:
    """Parse JSON text once into a typed struct; malformed text gives NULL."""
    return F.from_json(_c(text), schema, _NO_LIMITS)


def json_value_scalar(text: Column | str, path: str) -> Column:
    """Scalar at ``path`` as text, NULL when absent, JSON null, object or array.

    ``get_json_object`` would return the JSON text of a container; the
    warehouse's JSON_VALUE returns NULL there, so the variant's type decides.
    """
    v = F.try_variant_get(F.try_parse_json(_c(text)), path, "variant")
    kind = F.schema_of_variant(v)
    return F.when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")),
                  F.try_variant_get(v, "$", "string"))


def scalar_text(parsed: Column | str) -> Column:
    """A leaf that was parsed as text, as JSON_VALUE reads it: NULL when the
    document has an object or array there (a typed parse gives its JSON text).
    A string that itself spells a whole JSON container counts as one."""
    c = _c(parsed)
    return F.when(~c.rlike(r"^[\[{]") | ~is_valid_json(c), c)


def json_array(text: Column | str, path: str) -> Column:
    """Elements of the array at ``path`` as JSON text each; NULL when not an array."""
    return F.from_json(F.get_json_object(_c(text), path), T.ArrayType(T.StringType()))


def first_key(obj: Column | str) -> Column:
    """First key of a JSON object in alphabetical order (the warehouse lists
    keys sorted); NULL for a missing or empty object."""
    return F.try_element_at(F.array_sort(F.map_keys(_c(obj))), F.lit(1))


def is_valid_json(text: Column | str) -> Column:
    """True when the whole text is one JSON value, as Python's ``json.loads``
    would accept it (``NaN`` and the like aside); never NULL.

    The text is embedded before a sentinel member, which is only read when the
    value ends exactly where the text ends, and again inside an array, which
    rejects bare member lists such as ``1,"b":2``.  Only the sentinel is kept,
    so no parse tree is built and no size or depth is too large.
    """
    t = _c(text)
    options = _NO_LIMITS | {"allowSingleQuotes": "false"}
    whole = [F.from_json(F.concat(F.lit(a), t, F.lit(b)), "__end int", options)["__end"] == 1
             for a, b in (('{"d":', ',"__end":1}'), ('{"d":[', '],"__end":1}'))]
    return F.coalesce(whole[0] & whole[1], F.lit(False))
