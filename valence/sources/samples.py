"""Sample messages and the phrases of the event feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (text, source, user) of the producer's sample messages.
PRODUCER_SAMPLES = [
    ("This movie was fantastic!", "MovieReviews", "alice_w"),
    ("I really enjoyed this product.", "ProductReviews", "mark_dev"),
    ("The movie was boring.", "MovieReviews", "cinemafan99"),
    ("This was a terrible experience.", "CustomerCare", "sarah_k"),
    ("I love Apache Spark streaming and real-time big data!", "TechTwitter", "bigdata_guru"),
    ("Worst experience ever with this airline, flight cancelled without warning.", "Twitter", "traveler_dan"),
    ("The food was delicious and the ambiance was wonderful.", "YelpReviews", "foodie_jen"),
    ("I feel terrible about losing my keys today.", "SocialMedia", "random_user12"),
    ("Fantastic performance by the development team on the new release!", "SlackFeed", "techlead_sam"),
    ("Bad service and extremely rude staff at checkout.", "RetailFeedback", "buyer_902"),
    ("Kafka streaming with PySpark ML is awesome and lightning fast!", "TechTwitter", "spark_fan"),
    ("I don't like this app, it keeps crashing constantly.", "PlayStore", "mobile_tester"),
    ("This phone is horrible, battery dies in 2 hours.", "AmazonReviews", "gadget_guy"),
    ("Excellent customer support, resolved my issue within minutes!", "SupportDesk", "happy_client"),
    ("The package arrived at 3 PM as scheduled.", "LogisticsFeed", "tracker_bot"),
    ("Superb quality and clean design. Highly recommended to everyone!", "ProductReviews", "design_pro"),
    ("Completely broken update, nothing works anymore.", "GithubIssues", "coder_x"),
]
# Fixed values: (text, source, user) of the preset stream; it starts with the
# first four producer samples.
PRESET_SAMPLES = PRODUCER_SAMPLES[:4] + [
    ("Apache Spark MLlib and Kafka streaming make big data so easy!", "TechTwitter", "spark_hero"),
    ("I hate waiting in line for 2 hours, worst customer service ever.", "SupportFeed", "angry_traveler"),
    ("The pizza was absolutely delicious and freshly baked!", "FoodBlog", "chef_mario"),
    ("My phone is lagging and battery drains way too fast.", "GadgetReviews", "tech_user88"),
    ("Super fast delivery and flawless packaging. 5 stars!", "AmazonStore", "happy_shopper"),
    ("The application crashed again after the latest update.", "AppStoreReviews", "bug_reporter"),
    ("The weather forecast predicts light rain in the afternoon.", "NewsWire", "meteo_bot"),
    ("Outstanding presentation by the team today, great job!", "SlackWorkspace", "lead_engineer"),
    ("Terrible battery life and poor screen quality, completely regret buying.", "HardwareReviews", "buyer_301"),
    ("I love the new dark mode interface, it looks stunning!", "DesignCommunity", "ui_designer"),
]
# Short texts of the line file, then cases for single rules.
LINE_TEXTS = [
    "I love Apache Spark", "This movie is amazing", "I hate this product", "Worst experience ever",
    "The food was delicious", "I am very happy today", "I feel terrible", "Fantastic performance", "Bad service",
    "Spark MLlib is awesome", "Hadoop is very useful", "Kafka streaming is excellent", "I don't like this app",
    "This phone is horrible", "Excellent customer support",
]
RULE_TEXTS = [
    "not very good", "not bad", "hardly good", "good bad", "great \U0001F61E", "top-notch", "love slow", "hate clean",
    "\U0001F44D\U0001F525 new phone", "\U0001F621 again", "❤ bare heart", "❤️ heart",
    "I don’t love it", "I don't love it", "Not. Good food", "extremely worst", "not not good", "somewhat good",
    "good good good", "never really helpful", "no problem", "   ",
]
FEED_PHRASES = [text for text, _, _ in PRODUCER_SAMPLES + PRESET_SAMPLES[4:]] + LINE_TEXTS + RULE_TEXTS


def sample_messages(spark: SparkSession) -> DataFrame:
    """Both sample sets, one after the other, as ``text, source, user`` rows."""
    return spark.createDataFrame(PRODUCER_SAMPLES + PRESET_SAMPLES, "text string, source string, user string")
