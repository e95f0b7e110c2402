"""millrace: a Spark-native engine for curating and auditing text corpora.

The core (functions, operators, sources, plans, streaming) never imports the optional ``llm`` subpackage.
"""

__version__ = "0.1.0"
