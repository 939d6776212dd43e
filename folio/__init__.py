"""folio — a Spark-native engine for building and curating web-article corpora.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``);
the only Python boundary is the Arrow-batched HTML pass in
``folio.operators.html_pass``.
"""

__version__ = "0.1.0"
