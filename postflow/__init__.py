"""postflow: social-post analytics on Spark.

Reads post messages (Kafka, socket or files; streaming or batch), flattens them into post
tables kept by key, counts hashtags continuously, ranks authors, hydrates id lists by a
distributed join and tags posts by keyword rules. Everything is DataFrame / SQL-function code.
"""

__version__ = "0.1.0"
