"""Argument checks shared by the public functions."""

import math
import re


def check_type(name, value, kind):
    """Raise TypeError unless ``value`` is a ``kind``; a bool is no number."""
    kinds = kind if isinstance(kind, tuple) else (kind,)
    if not isinstance(value, kinds) or (isinstance(value, bool) and bool not in kinds):
        wanted = " or ".join(k.__name__ for k in kinds)
        raise TypeError(f"{name} must be {wanted}, got {type(value).__name__}")


def check_model_name(name):
    check_type("name", name, str)
    if not re.match(r"^\w+$", name):
        raise ValueError(f"model name {name!r} may hold only letters, digits and underscores")


def check_n_periods(n_periods):
    check_type("n_periods", n_periods, int)
    if not 0 < n_periods <= 52:
        raise ValueError(f"n_periods must be between 1 and 52, got {n_periods}")


def check_n_recommendations(n, n_items):
    check_type("n", n, int)
    if not 1 <= n <= n_items:
        raise ValueError(f"n must be between 1 and the number of items ({n_items}), got {n}")


def check_test_size(test_size, length=None):
    check_type("test_size", test_size, (int, float))
    if not math.isfinite(test_size) or test_size <= 0 or (length is not None and test_size >= length):
        raise ValueError(f"test_size must be above 0 and below the length, got {test_size}")
