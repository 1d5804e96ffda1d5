"""DataFrame operators for text analytics and question-answering data on Spark."""
