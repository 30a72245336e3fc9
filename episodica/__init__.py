"""Episodica: a PySpark-native engine for agent transcripts and training corpora."""
