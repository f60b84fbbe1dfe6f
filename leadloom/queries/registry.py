"""All queries outside the training-text subpackage."""

from __future__ import annotations

from . import contacts, controls, dictionaries, extras, fields, gates, joins, reports, sites, streams
from .common import Registry

REGISTRY = Registry()
for _module in (fields, gates, joins, reports, contacts, streams, extras, dictionaries, sites, controls):
    _module.register(REGISTRY)
