"""All thresholds in one frozen object that every rule takes."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DetectionConfig:
    # Access-log rules.
    brute_force_attempts: int = 5
    brute_force_window_s: int = 60
    port_scan_endpoints: int = 8
    port_scan_window_s: int = 5
    burst_ips: int = 5
    burst_requests: int = 5
    unavailable_errors: int = 3
    work_hours_start: int = 6
    work_hours_end: int = 22
    high_activity_requests: int = 20
    # Packet rules.
    port_hits: int = 15
    ports_per_source: int = 15
    volume_window: int = 500
    volume_limit: int = 300
    recent_packets: int = 1000
    max_packet_size: int = 1500
    rate_window_s: int = 60
    rate_limit: int = 30
    failed_logins: int = 5
    # Rule classifier, and the quantiles of its training step.
    classifier_ports: float = 5
    classifier_packets: float = 100
    classifier_small_size: float = 100
    classifier_small_packets: float = 20
    fit_high_quantile: float = 0.95
    fit_low_quantile: float = 0.05
    # Alerts.
    alert_history: int = 100
    dashboard_history: int = 200
    # Named feature sets.
    idle_gap_s: float = 5.0
    subflow_gap_s: float = 1.0
    site_host: str = "example.com"
    # Streams.
    watermark: str = "2 minutes"
    #: Running values of an address start anew when it was silent for so long; never, if None.
    idle_state_s: float | None = None
    trigger: str = "500 milliseconds"


DEFAULTS = DetectionConfig()
