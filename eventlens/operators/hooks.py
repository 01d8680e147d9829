"""One contract for models: generators, encoders and metrics as named, batched hooks.

A hook is either a model, built once in a worker process and called with whole
batches, or a native column expression that needs no Python at all.  Batch size
and options (generation limits and the like) belong to the hook of a stage, so
each stage has its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

KINDS = ("generator", "encoder", "metric")


@dataclass(frozen=True)
class Hook:
    """``factory()`` gives ``call(*lists, **options) -> list``; or ``column(*columns, **options)`` gives a column.

    ``factory`` is a module-level function (or a partial of one), so that a
    worker can tell that it has built the model already.
    """

    factory: Callable | None = None
    column: Callable[..., Column] | None = None
    batch_size: int = 16
    options: tuple[tuple[str, object], ...] = ()

    def __post_init__(self):
        if (self.factory is None) == (self.column is None):
            raise ValueError("a hook has either a factory or a column")
        if self.batch_size < 1:
            raise ValueError("batch_size must be 1 at least")

    def with_options(self, batch_size: int | None = None, **options) -> Hook:
        """The same model with other limits."""
        return replace(self, batch_size=batch_size or self.batch_size, options=tuple(sorted((dict(self.options) | options).items())))


_HOOKS: dict[tuple[str, str], Hook] = {}


def register_hook(kind: str, name: str, hook: Hook) -> Hook:
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}; one of {KINDS}")
    _HOOKS[kind, name] = hook
    return hook


def get_hook(kind: str, name: str) -> Hook:
    if (kind, name) not in _HOOKS:
        raise KeyError(f"no {kind} named {name!r}; there are {sorted(n for k, n in _HOOKS if k == kind)}")
    return _HOOKS[kind, name]


@lru_cache(maxsize=8)
def _model(factory: Callable):
    return factory()


def apply_hook(df: DataFrame, hook: Hook, inputs: str | list[str], out: str, returns: str = "string") -> DataFrame:
    """Add column ``out``: the hook's results for the input columns (text nulls reach a model as empty strings)."""
    names = [inputs] if isinstance(inputs, str) else list(inputs)
    options = dict(hook.options)
    if hook.column is not None:
        return df.withColumn(out, hook.column(*[F.col(c) for c in names], **options))
    factory, size = hook.factory, hook.batch_size
    schema = StructType([*[f for f in df.schema.fields if f.name != out], StructField(out, _parse_datatype_string(returns))])
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(factory)
        for batch in batches:
            for i in range(0, batch.num_rows, size):
                part = batch.slice(i, size)
                lists = [["" if x is None else x for x in part.column(c).to_pylist()] for c in names]
                done = list(model(*lists, **options))
                if len(done) != part.num_rows:
                    raise ValueError(f"a hook returned {len(done)} results for {part.num_rows} inputs")
                target = pa.RecordBatch.from_pydict({out: pa.array(done, kinds[-1])})
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], target.column(0)], [*kept, out])

    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(schema.fields[-1].dataType)]
    return df.mapInArrow(run, schema)
