"""Composed runs (transport step, failure policy) and the query catalog."""
