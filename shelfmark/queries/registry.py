"""All registered queries by name."""

from . import refining, requests, searching

ALL = {**refining.QUERIES, **requests.QUERIES, **searching.QUERIES}
