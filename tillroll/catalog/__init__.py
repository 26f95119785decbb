"""The registered queries, by area."""


def load():
    """Import every area, which registers its queries."""
    from tillroll.catalog import (  # noqa: F401
        cleaning, customers, forecast, metrics, predictor, profile, recommend, registry, series, storage,
    )

    return registry
