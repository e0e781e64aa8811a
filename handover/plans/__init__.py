"""End-to-end plans: migration run, publishing, registered queries."""
