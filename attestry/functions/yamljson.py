"""YAML text to JSON text, the one step Spark has no built-in for."""

from __future__ import annotations

import functools
import json
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Send this module's functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@functools.cache
def _loader():
    import yaml

    class Core(yaml.SafeLoader):
        """YAML 1.2 core scalars: dates and yes/no stay text, keys are unique."""

        def construct_mapping(self, node, deep=False):
            self.flatten_mapping(node)
            seen = set()
            for key_node, _ in node.value:
                key = self.construct_object(key_node, deep=True)
                if key in seen:
                    raise yaml.constructor.ConstructorError(None, None, f"duplicate key {key!r}")
                seen.add(key)
            return super().construct_mapping(node, deep)

    Core.yaml_implicit_resolvers = {}
    for tag, pattern, first in [
        ("bool", r"^(?:true|True|TRUE|false|False|FALSE)$", "tTfF"),
        ("null", r"^(?:~|null|Null|NULL|)$", ["~", "n", "N", ""]),
        ("int", r"^(?:[-+]?[0-9]+|0x[0-9a-fA-F]+)$", "-+0123456789"),
        ("float", r"^[-+]?(?:\.[0-9]+|[0-9]+(?:\.[0-9]*)?)(?:[eE][-+]?[0-9]+)?$", "-+.0123456789"),
        ("merge", r"^(?:<<)$", "<"),
    ]:
        Core.add_implicit_resolver(f"tag:yaml.org,2002:{tag}", re.compile(pattern), list(first))

    def number(loader, node):
        text = loader.construct_scalar(node).lower()
        if text.startswith("0x"):
            return int(text, 16)
        value = float(text)
        return int(value) if value.is_integer() else value

    Core.add_constructor(
        "tag:yaml.org,2002:int",
        lambda loader, node: int(loader.construct_scalar(node), 16)
        if loader.construct_scalar(node).lower().startswith("0x")
        else int(loader.construct_scalar(node)),
    )
    Core.add_constructor("tag:yaml.org,2002:float", number)
    return Core


def _convert(texts: pd.Series) -> pd.Series:
    """JSON of a batch of texts; equal texts of the batch are parsed once."""
    import yaml

    core = _loader()

    def one(text):
        if text is None:
            return None
        try:
            return json.dumps(yaml.load(text, Loader=core), default=str, ensure_ascii=False)
        except (yaml.YAMLError, ValueError, TypeError, RecursionError):
            return None

    known = {text: one(text) for text in dict.fromkeys(texts)}
    return pd.Series([known[text] for text in texts], dtype=object)


def yaml_to_json(text: Column) -> Column:
    """JSON text of a YAML document; NULL where it does not parse.

    It is marked as not deterministic, so that the optimiser does not repeat it in a filter on its result.
    """
    udf = F.pandas_udf(_convert, "string").asNondeterministic()
    return udf(text)


def spread(texts: DataFrame) -> DataFrame:
    """Rows dealt evenly over the shuffle partitions, to be parsed there.

    Parsing takes far longer than reading: a file of short texts is one input split, and shuffled ones are few partitions
    by their size.
    """
    return texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
