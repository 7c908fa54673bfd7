"""Canonical JSON of a whole XML document: the one Python UDF of the library."""

from __future__ import annotations

import json
import sys
from xml.parsers import expat

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# Executors get these functions by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _element_value(attributes: dict, children: dict, text: str):
    content = {f"@{name}": value for name, value in attributes.items()}
    content.update(children)
    text = text.strip()
    if not content:
        return text or None
    if text:
        content["#text"] = text
    return content


def _document(xml: str) -> dict:
    """One XML text as nested dicts: repeats become lists, empty elements None."""
    parser = expat.ParserCreate()
    parser.buffer_text = True
    open_elements = [({}, {}, [])]

    def opened(_name, attributes):
        open_elements.append((attributes, {}, []))

    def closed(name):
        attributes, children, texts = open_elements.pop()
        value = _element_value(attributes, children, "".join(texts))
        siblings = open_elements[-1][1]
        if name not in siblings:
            siblings[name] = value
        elif isinstance(siblings[name], list):
            siblings[name].append(value)
        else:
            siblings[name] = [siblings[name], value]

    def no_entities(*_):
        raise ValueError("entity declarations are not accepted")

    parser.StartElementHandler = opened
    parser.EndElementHandler = closed
    parser.CharacterDataHandler = lambda text: open_elements[-1][2].append(text)
    parser.EntityDeclHandler = no_entities
    parser.Parse(xml, True)
    return open_elements[0][1]


def _canonical(xml):
    if xml is None:
        return None
    try:
        return json.dumps(_document(xml), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    except (expat.ExpatError, ValueError):
        return None


@F.pandas_udf(T.StringType())
def xml_to_json(xml: pd.Series) -> pd.Series:
    """Canonical JSON of the whole document, unknown elements included.

    Spark's XML reader needs a schema and drops what the schema does not name, and
    its variant form turns ``012`` into ``12``; the stored payload must do neither.
    Only the raw layer asks for this column, the load path stays in the JVM.
    """
    return xml.map(_canonical)
