"""The labelled table for ``html_text``: small pages whose blocks are marked as article (+) or surroundings (-).

Each page is a list of marked pieces of markup; a piece's mark holds for all text blocks in it.
"""

PAGES: list[list[tuple[str, str]]] = [
    [
        ("-", "<nav><ul><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/about'>About us</a></li></ul></nav>"),
        ("-", "<div class='ad'>Buy two pairs of shoes today and get the third pair free of charge in all our shops.</div>"),
        ("+", "<article><h1>River rises after storm</h1><p>Rain fell for three days in the valley, and the river rose above its banks on Monday.</p><p>Nobody was hurt.</p><p>Read the <a href='/r'>report of the water board</a> for the levels measured at each of the bridges along the river this week.</p></article>"),
        ("-", "<footer>&copy; The Valley News. All rights reserved by the publisher and its partners.</footer>"),
    ],
    [
        ("-", "<header><a href='/'>The Daily Page</a><p>News from the coast since 1901, every morning</p></header>"),
        ("-", "<div class='cookie-notice'>We use cookies to make this site work and to measure how you use it. <a href='/c'>Settings</a></div>"),
        ("+", "<main><h1>New bridge opens</h1><p>The bridge was opened by the mayor in the morning and traffic began to flow at noon.</p><ul><li>Length: ninety metres</li><li>Cost: two million</li></ul><blockquote>We waited ten years.</blockquote></main>"),
        ("-", "<aside><h2>Most read</h2><ul><li><a href='/1'>Storm over the bay leaves harbour without power</a></li><li><a href='/2'>School gets a roof</a></li></ul></aside>"),
        ("-", "<section id='comments'><h2>Comments</h2><p>I have lived beside this river for forty years and never seen such a fine bridge.</p><p>Nice.</p></section>"),
    ],
    [
        ("-", "<div id='menu'><a href='/a'>Start</a> <a href='/b'>Archive</a> <a href='/c'>Contact</a></div>"),
        ("+", "<h1>How to keep bees in a small garden</h1><p>Bees need water, flowers and shelter from the wind, and a small garden can offer all three if it is planned with care.</p><p>Begin in spring, when the colonies are growing and swarms are easy to find in the neighbourhood.</p><p>A hive should face the morning sun so that the bees are warmed early and can fly out before the dew has dried.</p>"),
        ("-", "<form action='/s'><p>Sign up for our weekly letter with tips for your garden</p><label>Mail address</label></form>"),
        ("-", "<div><a href='/p'>Privacy</a> <a href='/t'>Terms</a></div>"),
    ],
    [
        ("-", "<div class='top-banner'>Sale ends on Sunday: everything in the shop at half price while stocks last.</div>"),
        ("-", "<ul class='breadcrumbs'><li><a href='/'>Home</a></li><li><a href='/x'>Science</a></li><li>Birds</li></ul>"),
        ("+", "<div class='post-content'><h2>Storks return</h2><p>Twelve pairs have been counted.</p><p>The first storks came back to the village in the second week of March, a little earlier than last year.</p><table><tr><th>Year</th><th>Pairs</th></tr><tr><td>One</td><td>Nine</td></tr></table></div>"),
        ("-", "<div class='related'><h3>Related</h3><p><a href='/y'>Cranes seen over the northern marshes again</a></p></div>"),
        ("-", "<div class='comments'><p>Lovely birds, we saw five of them from our kitchen window this morning before breakfast.</p></div>"),
    ],
    [
        ("-", "<div role='navigation'><a href='/1'>One</a><a href='/2'>Two</a></div>"),
        ("+", "<article><header><h1>On silence</h1><p>By a guest</p></header><p>Yes.</p><p>Silence is not the absence of sound, as those who live beside a stream will tell you when they are asked.</p><p>No.</p></article>"),
        ("-", "<article class='advert'><p>This lamp changes its colour with your mood and can be yours for the price of a coffee a day.</p></article>"),
        ("-", "<div class='sidebar'><p>Follow us</p><p>Our editors choose the best stories of the week and send them to you on Friday.</p></div>"),
    ],
    [
        ("-", "<p><a href='/login'>Log in</a></p>"),
        ("+", "<p>The committee met on Tuesday and agreed on a plan for the park which will be shown to the public in autumn.</p><p>It contains a pond, two hundred trees and a path for cyclists that leads from the station to the school.</p><p>Work is to begin as soon as the money has been granted by the province, which is expected before the winter.</p>"),
        ("-", "<p><a href='/n1'>Next story</a></p><p><a href='/n2'>Earlier story about the park and the pond</a></p>"),
        ("-", "<p>Imprint</p>"),
    ],
    [
        ("-", "<div class='notice'>This site will be closed for maintenance on Saturday night between one and three.</div>"),
        ("+", "<article><p>Short note.</p><p><a href='/long'>The long version of this note can be found here</a></p><p>It was written in haste and says little, but it was written by hand and that is something in these days.</p></article>"),
        ("-", "<div class='share'><a href='/f'>Share</a> <a href='/t'>Post</a></div>"),
        ("-", "<footer><p>Printed in small numbers by friends of the house for readers everywhere</p><a href='/i'>Imprint</a></footer>"),
    ],
    [
        ("-", "<nav><a href='/'>Front page</a><a href='/sport'>Sport</a></nav>"),
        ("+", "<article><h1>A draw</h1><p>Both teams had chances in the first half but neither keeper was beaten before the break.</p><p>It ended level.</p></article>"),
    ],
    [
        ("+", "<article><p>To be continued.</p><p><a href='/next'>Part two</a></p></article>"),
    ],
    [
        ("-", "<p><a href='/h'>Home</a> <a href='/m'>Maps</a> <a href='/k'>Contact</a></p>"),
        ("+", "<h1>Walking the ridge</h1><p>The path leaves the village by the mill and climbs through beech woods to an open ridge with wide views.</p><p>Take water with you, because the springs marked on older maps have been dry for most of the last ten summers.</p>"),
    ],
    [
        ("+", "<p>There is only this one paragraph on the page, and it says what there is to say about it.</p>"),
    ],
    [
        ("+", "<main><p>Closed.</p></main>"),
        ("-", "<footer><a href='/map'>Site map</a> and all our other pages in one long list</footer>"),
    ],
    [
        ("-", "<div><a href='/s1'>Shop</a></div>"),
        ("+", "<p>The museum shows two hundred clocks, some of which still run and strike the hours one after another for a long while.</p><p>Entry is free on the first Sunday of every month, and children may wind the oldest clock if they ask at the desk.</p>"),
        ("-", "<p>Made with care</p>"),
    ],
    # Articles whose own markup tells them, with short lines and links of theirs.
    [
        ("+", "<article><h1>Song of the mill</h1><p>Round</p><p>and round</p><p>it goes</p><p>Amen</p></article>"),
        ("-", "<footer><a href='/'>Songs</a></footer>"),
    ],
    [
        ("-", "<nav><a href='/'>Home</a><a href='/poems'>Poems</a></nav>"),
        ("+", "<article><p>Snow on the gate,</p><p>nobody came,</p><p>nobody left.</p><p><a href='/poet'>The poet</a></p><p>1911</p></article>"),
    ],
    [
        ("-", "<header><a href='/'>Archive</a></header>"),
        ("+", "<main><h1>Index of letters</h1><ul><li><a href='/l1'>To his brother</a></li><li><a href='/l2'>To the bishop</a></li><li><a href='/l3'>To nobody</a></li></ul><p>End</p></main>"),
        ("-", "<footer>Archive of the county</footer>"),
    ],
    [
        ("+", "<article><p>Yes</p></article>"),
    ],
    [
        ("-", "<aside><p>Your account and your orders can be found in the shop</p></aside>"),
        ("+", "<article><h2>Parts</h2><p>One</p><p>Two</p><p><a href='/three'>Three</a></p></article>"),
        ("-", "<div class='comments'><p>First</p><p>I have built it too and it works well</p></div>"),
    ],
    # Pages without telling names: what is around the text is told by words and links alone.
    [
        ("-", "<div><a href='/'>Home</a> <a href='/walks'>Walks</a> <a href='/maps'>Maps</a></div><div><a href='/login'>Log in</a></div>"),
        ("+", "<h1>The mill path</h1><p>The path follows the stream from the old mill to the weir and crosses it twice on narrow wooden bridges.</p><p>After rain the second bridge can be slippery, and walkers with small children should take the lane above it.</p><p>Allow two hours for the round, or three if you mean to stop at the chapel and its garden.</p>"),
        ("-", "<div><a href='/next'>Next walk</a></div><div><a href='/a'>Ridge</a> <a href='/b'>Lakes</a> <a href='/c'>Coast</a></div><div>Made in the valley</div>"),
    ],
    [
        ("-", "<ul><li><a href='/1'>Politics</a></li><li><a href='/2'>Sport</a></li><li><a href='/3'>Weather</a></li><li><a href='/4'>Culture</a></li></ul>"),
        ("+", "<h1>Harbour to be dredged</h1><p>The town will dredge the inner harbour in spring so that larger boats can land their catch at low tide.</p><p>Work is planned to last six weeks and will cost less than was feared a year ago.</p><p>Fishermen welcomed the plan, though some would have liked it to begin before the winter storms.</p>"),
        ("-", "<div><a href='/5'>Boat races moved to June</a></div><div><a href='/6'>Old lighthouse gets a new lamp after all</a></div><div><a href='/7'>Letters</a></div>"),
    ],
    [
        ("-", "<table><tr><td><a href='/'>Start</a></td><td><a href='/list'>List</a></td></tr></table>"),
        ("+", "<p>In this lesson we look at how a sundial is laid out for the place where it is to stand, and why one bought elsewhere shows the wrong time.</p><p>You need a compass, a ruler and the latitude of your garden, which any map will tell you.</p><p>Draw the noon line first, then the hours on either side of it, as the table in the next lesson shows.</p>"),
        ("-", "<p><a href='/l1'>Lesson one</a> | <a href='/l3'>Lesson three</a></p><p>Last changed in May</p>"),
    ],
    [
        ("-", "<div><span><a href='/en'>English</a></span> <span><a href='/fr'>French</a></span></div><div><a href='/'>Museum</a> <a href='/tickets'>Tickets</a> <a href='/visit'>Visit</a></div>"),
        ("+", "<h2>The clock room</h2><p>Forty clocks stand in this room, and on the hour those that still run strike one after another for nearly a minute.</p><h2>The garden</h2><p>The garden was laid out by the last owner, who grew only plants that flower at night.</p><ul><li>Open from ten to five every day but Monday</li><li>Children under six are free of charge</li></ul>"),
        ("-", "<div><a href='/shop'>Shop</a></div><div><a href='/press'>Press</a> <a href='/jobs'>Jobs</a> <a href='/terms'>Terms</a></div>"),
    ],
    [
        ("-", "<p><a href='/a'>Recipes</a> <a href='/b'>Ingredients</a> <a href='/c'>Kitchens</a></p>"),
        ("+", "<h1>Bread with seeds</h1><p>Soak the seeds overnight in twice their weight of water, and mix them into the dough only when it has begun to rise.</p><p>Bake for forty minutes with steam.</p><p>The loaf keeps for a week in a cloth, and its taste is best on the second day, when the crust has softened a little.</p>"),
        ("-", "<p><a href='/d'>Rye bread</a></p><p><a href='/e'>Flat bread from the hot stone</a></p><p><a href='/f'>All breads</a></p>"),
    ],
    [
        ("-", "<div><a href='/'>Forum</a></div><div><a href='/r'>Rules</a></div>"),
        ("+", "<p>I have measured the spring flow of our well every morning for eleven years and would like to share what I found.</p><p>It falls in May, whatever the winter was like, and comes back with the first long rain after the harvest.</p><p>The two driest years were not the hottest, which surprised me more than anything else in the figures.</p>"),
        ("-", "<div><a href='/p1'>1</a> <a href='/p2'>2</a> <a href='/p3'>3</a></div><div><a href='/top'>Top of page</a></div>"),
    ],
    [
        ("-", "<p><a href='/x'>Skip</a></p><p><a href='/y'>Index</a></p>"),
        ("+", "<h1>Minutes of the meeting</h1><p>Present were nine members; three had sent their regrets.</p><p>The treasurer reported that the roof fund stands at two thirds of what is needed, and thanked all who gave.</p><p>See the <a href='/budget'>budget</a> for how the rest is to be raised before the builders come in autumn.</p><p>The meeting closed at ten.</p>"),
        ("-", "<p><a href='/m1'>January</a> <a href='/m2'>February</a> <a href='/m3'>March</a></p>"),
    ],
]
