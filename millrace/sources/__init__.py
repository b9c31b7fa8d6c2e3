"""Text, message-queue and database sources."""
