"""tarnlake: a Spark-native engine for preparing text corpora, chat trees and preference data."""
