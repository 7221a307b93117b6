"""End-to-end plans (inference, retraining, training) and the query catalog."""


def load_all() -> None:
    """Import every module that registers catalog queries."""
    from txguard.plans import entries_core, entries_model, entries_ops, entries_quality  # noqa: F401
