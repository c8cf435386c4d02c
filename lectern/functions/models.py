"""Models built once per Python worker.

A factory travels with every task, so its identity says nothing; the key under
which a worker keeps the model is taken on the driver, when the operator is
built. Classes, functions and ``functools.partial`` of them have a lasting key;
any other factory gets one for its operator. A worker keeps few models.
"""

from __future__ import annotations

import functools
import uuid

MAX_MODELS = 4

_MODELS: dict[str, object] = {}


def model_key(factory) -> str:
    inner, args = factory, ""
    if isinstance(factory, functools.partial):
        inner, args = factory.func, repr((factory.args, sorted(factory.keywords.items())))
    name = f"{getattr(inner, '__module__', '')}.{getattr(inner, '__qualname__', '')}"
    if "<" in name or name.endswith(".") or "__main__" in name or getattr(inner, "__closure__", None):
        return uuid.uuid4().hex
    return name + args


def worker_model(key: str, factory):
    if key not in _MODELS:
        while len(_MODELS) >= MAX_MODELS:
            _MODELS.pop(next(iter(_MODELS)))
        _MODELS[key] = factory()
    return _MODELS[key]
