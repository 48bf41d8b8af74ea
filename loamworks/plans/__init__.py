"""Registered queries; importing this package registers all of them."""

from . import conversations, corpus, metrics, sources, tokens  # noqa: F401
