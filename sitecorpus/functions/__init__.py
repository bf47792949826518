"""Scalar Column functions (JVM-side expressions only)."""

from sitecorpus.functions.text import (  # noqa: F401
    collapse_spaces, is_blank, py_strip, slug, SPACE_CHARS,
)
from sitecorpus.functions.urls import url_domain, url_error, url_filename, url_parts  # noqa: F401
