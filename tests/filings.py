"""Hand-made filings for the flow tests."""

META = """<html><body>
<h1>ITEM 1. BUSINESS</h1><p>We build technology that helps people connect and share with friends and family all over the world.</p>
<p>Advertising revenue comes in here. Substantially all of our revenue from selling advertising placements on our family of apps to marketers, which is displayed on mobile devices and computers.</p>
<h2>Note 2 - Revenue</h2>
<p>Other revenue consists of WhatsApp Business Platform sales, Meta Verified subscriptions and various other sources.</p>
<h3>Disaggregation of Revenue</h3>
<p>Revenue disaggregated by revenue source and by segment (in millions):</p>
<table>
<tr><td></td><td colspan="2">2024</td><td colspan="2">2023</td></tr>
<tr><td>Advertising</td><td>$</td><td>160,633</td><td>$</td><td>131,948</td></tr>
<tr><td>Other revenue</td><td></td><td>1,722</td><td></td><td>1,058</td></tr>
<tr><td>Family of Apps</td><td></td><td>162,355</td><td></td><td>133,006</td></tr>
<tr><td>Reality Labs</td><td></td><td>2,146</td><td></td><td>1,896</td></tr>
<tr><td>Total revenue</td><td>$</td><td>164,501</td><td>$</td><td>134,902</td></tr>
</table>
<h3>Deferred items</h3><p>Deferred revenue schedule</p>
<table><tr><td>Deferred revenue</td><td>2024</td></tr><tr><td>Current</td><td>12</td></tr><tr><td>Later</td><td>5</td></tr></table>
<h2>Consolidated Statements of Income</h2><p>(in millions, except per share)</p>
<table>
<tr><td></td><td>2024</td><td>2023</td></tr>
<tr><td>Revenue</td><td>164,501</td><td>134,902</td></tr>
<tr><td>Cost of revenue</td><td>30,161</td><td>25,959</td></tr>
<tr><td>Net income</td><td>62,360</td><td>39,098</td></tr>
</table>
</body></html>"""

AMZN = """<html><body><h2>Net sales by groups of similar products and services</h2>
<p>Net sales by groups of similar products and services are as follows (in millions):</p>
<table>
<tr><th></th><th>2023</th><th>2024</th></tr>
<tr><td>Online stores <sup>(1)</sup></td><td>$ 231,872</td><td>$ 247,029</td></tr>
<tr><td>Physical stores (2)</td><td>20,030</td><td>21,215</td></tr>
<tr><td>AWS</td><td>90,757</td><td>107,556</td></tr>
<tr><td>Consolidated</td><td>342,659</td><td>375,800</td></tr>
</table>
<p>_____ (1) Includes product sales and digital media content where we record revenue gross. (2) Includes product sales where our customers physically select items in a store.</p>
</body></html>"""
